"""The pipeline stage by stage against brute force on what each stage was given."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as p
from cyclewise.llm import decontaminate, mixing
from tests.compare import compare, duck
from tests.llm.edge import SCHEMA, edge_docs
from tests.llm.test_chunk_dedup import _brute as brute_chunks
from tests.llm.test_dart_minhash import _brute as brute_groups
from tests.llm.test_decontaminate import _brute as brute_leaks


def _pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_equal_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    steps = dict(p.STAGES)

    def written(name, df):
        path = f"{tmp_path}/{name}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    first = written("language", steps["language"](spark, docs, sf_dir))
    assert first.columns == columns and first.count() >= 0.99 * docs.count()

    second = written("near_duplicates", steps["near_duplicates"](spark, first, sf_dir))
    given = _pairs(first)
    classes = brute_groups(given)
    assert _pairs(second) == [(d, t) for d, t in given if classes[d] == d]

    third = written("substrings", steps["substrings"](spark, second, sf_dir))
    cut = brute_chunks(_pairs(second))
    assert _pairs(third) == sorted((d, t) for d, t in cut if t.strip())
    assert third.filter("n_chars != length(text)").count() == 0

    fourth = written("decontamination", steps["decontamination"](spark, third, sf_dir))
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    leaky = {d for d, _ in brute_leaks(_pairs(third), items)}
    assert _pairs(fourth) == [(d, t) for d, t in _pairs(third) if d not in leaky]
    assert [x.columns for x in (second, third, fourth)] == [columns] * 3

    last = steps["mix"](spark, fourth, sf_dir)
    con = duck(sf_dir)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/decontamination/*.parquet'")
    tokens = last.select("doc_id", *mixing.LEVELS, mixing.n_tokens(last["text"]).alias("n_tokens"), "epoch")
    assert compare(tokens, mixing.mix_sql(), con) == []
    assert set(columns) <= set(last.columns)

    whole = p.run(spark, sf_dir)
    assert sorted(map(str, whole.select("doc_id", "epoch").collect())) == sorted(map(str, last.select("doc_id", "epoch").collect()))


def test_each_stage_takes_edge_rows_and_empty_tables(spark, sf_dir):
    docs = edge_docs(spark)
    empty = spark.createDataFrame([], SCHEMA)
    kept = {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, sf_dir)
        kept[name] = sorted(str(r["doc_id"]) for r in out.collect())
        if name != "mix":
            assert out.columns == docs.columns
        assert stage(spark, empty, sf_dir).count() == 0
    assert set(kept["language"]) == {"1", "5", "7", "8", "None"}
    assert kept["near_duplicates"] == sorted(["1", "2", "3", "4", "None", "None", "5", "6", "7", "8"])
    assert len(kept["substrings"]) == len(kept["decontamination"]) == docs.count()


def test_no_benchmark_text_passes(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = decontaminate.find_leaks(p.run(spark, sf_dir), items)
    assert leaks.count() == 0


def test_clashing_names_and_white_space(spark, sf_dir):
    passage = " ".join(f"passage{i}" for i in range(120))
    names = ["_found", "found", "doc", "_new", "_doc"]
    rows = [(1, "\n" + passage, None, "s", 3), (2, "\n\t\u00a0" + passage + "\u2003\n", "en", "s", 3), (3, None, None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in names:
        docs = docs.withColumn(name, F.lit(7).cast("long"))
    for stage in (p.language, p.substrings):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and {tuple(r[n] for n in names) for r in out.collect()} <= {(7,) * 5}
    assert {r["doc_id"] for r in p.substrings(spark, docs, sf_dir).collect()} == {1, 3}
