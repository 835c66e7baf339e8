"""Registered queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm import chunk_dedup, dart_minhash, decontaminate, fill_middle, filter_audit, langid, license_rules, mixing, pii_crf, prefix_hash, rule_quality, tag_paths, warc
from cyclewise.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and names of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_rules.scan_licenses(docs).drop("text")


SQL["op1_license_scan"] = license_rules.license_sql()


@_register
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that fill the token budget, one row per epoch in which they are read."""
    rows = mixing.counted(table(spark, sf_dir, "documents"))
    return mixing.take_mix(rows, mixing.plan_mix(rows))


SQL["op9_source_mix"] = mixing.mix_sql()


@_register
def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page as WARC and read the records back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@_register
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix-hash fingerprints of every text and of its edited text."""
    return prefix_hash.fingerprints(table(spark, sf_dir, "documents"))


@_register
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return tag_paths.extract(table(spark, sf_dir, "pages"))


@_register
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and language spans of every text."""
    return langid.identify(table(spark, sf_dir, "documents"))


@_register
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    return rule_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, one row per document and item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return dart_minhash.groups(table(spark, sf_dir, "documents"))


@_register
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunk_dedup.dedup(docs).withColumn("n_chars", F.length("text"))


@_register
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all orders, per source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op13_filter_audit"] = filter_audit.audit_sql()


@_register
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every text, and the text restored from it."""
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


SQL["op12_fill_middle"] = fill_middle.fill_middle_sql()


@_register
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: counts and digest of the patterns' spans, and all spans."""
    return pii_crf.digests(pii_crf.find(table(spark, sf_dir, "documents")))
