"""Corpus pipeline: from documents to a training mix, in five stages.

Every stage takes what its predecessor kept, written as Parquet and read again:

1. ``language``: texts without a language (no text, no letter) or without a main language
   (no language has half of the letters) go; a missing ``lang`` is filled in.
2. ``near_duplicates``: one document, the one of smallest id, stays of each group.
3. ``substrings``: passages that an earlier document has are cut out; a document of which
   nothing is left goes.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``mix``: documents are drawn to target weights of the tree domain, language, source; a
   document comes once per ``epoch`` in which it is read.

The first four return the columns of ``documents``. Rows with null ids or texts, repeated
rows and empty tables have the results that the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm import chunk_dedup, dart_minhash, decontaminate, langid, mixing
from cyclewise.llm.common import prepare, stored, table

#: Share of the letters that the main language has at least.
MAIN_SHARE = 0.5

#: A character that is no white space.
SOLID = r"[^\s\p{Z}\x{85}\x{1C}-\x{1F}]"

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = langid.learn(langid.learned_rows(docs))
    # rows and labels travel as one value each, so the columns may have any names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    found = rows.withColumn("found", langid.labeller(spark, model)("doc.text"))
    kept = found.filter((F.col("found.lang") != langid.UNKNOWN) & (F.col("found.score") >= MAIN_SHARE))
    lang = F.coalesce("doc.lang", "found.lang")
    return kept.select(*[(lang if c == "lang" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = chunk_dedup.dedup(docs)
    changed = F.coalesce(F.col("removed_chars") > 0, F.lit(False))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return out.filter(~changed | F.col("text").rlike(SOLID)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
