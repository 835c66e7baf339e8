"""Content-defined chunks and the removal of repeated passages."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cyclewise.llm import chunk_dedup as c
from cyclewise.llm.queries import QUERIES
from tests.llm.edge import SCHEMA, edge_docs


def _words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopé", k=rng.randint(2, 9))) for _ in range(n))


def _chunks(text):
    data = text.encode()
    begin, end = c.chunk_borders([data])
    return [data[a:b] for a, b in zip(begin, end)]


def test_gear_hash_is_the_rolling_sum():
    data = np.frombuffer(_words(random.Random(1), 40).encode(), np.uint8)
    h = c.gear_hashes(data)
    for i in range(c.WINDOW, len(data)):
        rolled = 0
        for b in data[i - c.WINDOW + 1 : i + 1]:
            rolled = (rolled * 2 + int(c.GEAR[b])) % 2**32
        assert rolled == h[i]


def test_chunks_cover_texts_and_resist_insertions():
    rng = random.Random(2)
    text = _words(rng, 2_000)
    parts = _chunks(text)
    assert b"".join(parts) == text.encode()
    assert min(map(len, parts[1:-1])) > c.RADIUS and max(map(len, parts)) <= c.LONGEST
    moved = _chunks("shift " + text[:5_000] + " inserted words here " + text[5_000:])
    assert len(set(parts) & set(moved)) > 0.97 * len(parts)
    begin, end = c.chunk_borders([b"", text.encode(), b"", b"ab", text.encode()])
    joined = text.encode() + b"ab" + text.encode()
    again = [joined[a:b] for a, b in zip(begin, end)]
    assert again == parts + [b"ab"] + parts
    assert max(map(len, _chunks("a" * 20_000))) <= c.LONGEST


def _brute(rows, least=c.RUN_WORDS):
    """The same decisions from one dictionary of chunks."""
    first = {}
    for doc_id, text in rows:
        if doc_id is not None and text is not None:
            for piece in _chunks(text):
                first[piece] = min(first.get(piece, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        if doc_id is None or text is None:
            out.append((doc_id, text))
            continue
        places, at = [], 0
        for piece in _chunks(text):
            if first[piece] < doc_id:
                places.append(at << 32 | at + len(piece))
            at += len(piece)
        out.append((doc_id, c.cut(text, places, least)[0]))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op3_substring_dedup"](spark, sf_dir).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == _brute(rows)
    old = dict(rows)
    for r in got:
        assert len(old[r["doc_id"]]) - len(r["text"]) == r["removed_chars"]
        assert bool(r["first_ids"]) == bool(r["removed_spans"]) and all(f < r["doc_id"] for f in r["first_ids"])


def test_passages_over_fifty_words_go_and_clean_texts_stay(spark):
    rng = random.Random(3)
    passages = [_words(rng, 52) for _ in range(40)]
    line = _words(rng, 8)
    rows, clean = [], set()
    for k in range(200):
        own = [_words(rng, rng.randint(5, 90)), line, _words(rng, 60)]
        if k % 2:
            own.insert(1, passages[k % 40 // 2 if k < 100 else (k % 40)])
        else:
            clean.add(k)
        rows.append((k, "\n".join(own)))
    got = {r["doc_id"]: r["text"] for r in c.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    old = dict(rows)
    assert all(got[k] == old[k] for k in clean)
    for p in passages:
        holders = sorted(k for k, t in old.items() if p in t)
        assert [k for k in holders if p in got[k]] == holders[:1]
        assert all(len(old[k]) - len(got[k]) > 0.4 * len(p) for k in holders[1:])


def test_edge_rows(spark):
    docs = edge_docs(spark)
    long_text = docs.filter("doc_id = 5").first()["text"]
    more = docs.unionByName(
        spark.createDataFrame([(9, "New start. " + long_text, "en", "s", 1, "x", 1), (None, long_text, "en", "s", 1, "x", 1), (5, "other", "en", "s", 1, "x", 1)], SCHEMA)
    )
    out = c.dedup(more)
    assert set(docs.columns) <= set(out.columns)
    rows = [(r["doc_id"], r["text"]) for r in more.collect()]
    got = out.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == _brute(rows)
    assert [len(r["text"]) for r in got if r["doc_id"] == 9][0] < 200
    assert c.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_clashing_names_survive(spark):
    names = ["_doc", "_check", "_places", "_first", "_new", "doc", "new", "places", "first", "text_check", "place", "digest"]
    passage = " ".join(f"passage{i}" for i in range(120))
    docs = spark.createDataFrame([(1, passage), (2, "before it all. " + passage)], "doc_id long, text string")
    plain = {r["doc_id"]: r for r in c.dedup(docs).collect()}
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    docs = docs.withColumn("removed_chars", F.lit("old"))
    out = c.dedup(docs)
    assert out.columns == ["doc_id", "text", *names, "removed_spans", "removed_chars", "first_ids"]
    for r in out.collect():
        assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names]
        for n in ("text", "removed_spans", "removed_chars", "first_ids"):
            assert r[n] == plain[r["doc_id"]][n]
    assert plain[2]["removed_chars"] > 0
