"""BM25 retrieval and overlap against brute force over all passages and segments."""

from __future__ import annotations

import random

import numpy as np

from cyclewise.llm import decontaminate as d
from cyclewise.llm.queries import QUERIES
from tests.llm.edge import SCHEMA, edge_docs

BENCH = "item_id long, text string, doc_id long"


def _brute(docs, items, threshold=d.THRESHOLD, least=d.OVERLAP):
    """Every passage against every segment, scored word by word."""
    segments = [s for i, t in sorted(set(items)) for s in d.segments_of(i, t)]
    index = d.Index(segments)
    table = np.zeros((len(index.postings) + 1, len(segments)))
    for w, p in enumerate(index.postings):
        table[w, p.segments] = p.impacts
    out = set()
    for doc_id, text in docs:
        words, stride = d.words_of(text), index.passage // 2
        for lo in range(0, max(1, len(words) - stride), stride):
            passage = words[lo : lo + index.passage]
            ids = sorted({index.number.get(w, len(index.postings)) for w in passage})
            for k in np.flatnonzero(table[ids].sum(0) >= threshold - 1e-9):
                s = segments[k]
                if min(d.overlap(s.question, passage, {}), d.overlap(s.answer, passage, {})) >= least:
                    out.add((doc_id, s.item_id))
    return out


def test_query_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op7_benchmark_leaks"](spark, sf_dir).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert got == _brute(docs, items) and len(got) == len(rows)
    whole = {(i, t) for i, t in docs}
    for item, text in items:
        needle = " " + " ".join(d.words_of(text)) + " "
        for doc_id, t in whole:
            if needle in " " + " ".join(d.words_of(t)) + " ":
                assert (doc_id, item) in got


def test_search_retrieves_all_above_threshold():
    rng = random.Random(2)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3_000)]
    segments = [s for i in range(90) for s in d.segments_of(i, " ".join(rng.choices(words, k=rng.randint(1, 30))))]
    for limit in (d.TABLE_BYTES, 0):
        d_limit, d.TABLE_BYTES = d.TABLE_BYTES, limit
        index = d.Index(segments)
        d.TABLE_BYTES = d_limit
        for threshold in (0.1, 0.4, 0.8):
            for _ in range(40):
                passage = rng.choices(words, k=40) + rng.choice(segments).words
                terms = sorted({index.number[w] for w in passage if w in index.number})
                scores = np.zeros(len(segments))
                for t in terms:
                    scores[index.postings[t].segments] += index.postings[t].impacts
                got = index.search(terms, threshold)
                assert sorted(k for k, _ in got) == list(np.flatnonzero(scores >= threshold - 1e-9))
                assert all(abs(scores[k] - x) < 1e-9 for k, x in got)


def test_long_items_edits_and_partial_answers(spark):
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in "abcdefghijklmnop" for b in "aeiouxyzqr"]
    item = rng.choices(vocabulary, k=40)
    text = " ".join(item[:30]) + ". " + " ".join(item[30:]) + "."
    long_item = " ".join(rng.choices(vocabulary, k=300))
    filler = " ".join(f"f{i}" for i in range(500))
    edited = text.replace(item[3], "changed")
    rows = [
        (1, f"{filler} {text} {filler}"), (2, f"{filler} {edited}"), (3, " ".join(item[:30])),
        (4, f"{filler} {' '.join(long_item.split()[100:200])}"), (5, " ".join(rng.sample(item, 40))), (6, filler),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, text, 9), (1, text, 9), (2, long_item, 9), (3, None, 9), (4, "...", 9), (None, "x", 9)], BENCH)
    got = {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()}
    assert {(1, 1), (2, 1), (4, 2)} <= got
    assert not any(doc in (3, 5, 6) for doc, _ in got)


def test_several_indexes_find_the_same(spark, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {(r["item_id"], r["text"]) for r in bench.collect()}
    parts = list(d.indexes_of(bench, 3_000))
    assert len(parts) > 1
    assert {s.item_id for p in parts for s in p.segments} == {i for i, _ in items}


def test_edge_rows(spark):
    docs = edge_docs(spark)
    bench = spark.createDataFrame([(1, "The cat sat on the mat. It was a good day for all of them.", 3)], BENCH)
    got = sorted((r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect())
    assert got == [(1, 1), (1, 1)]
    assert d.find_leaks(spark.createDataFrame([], SCHEMA), bench).count() == 0
    assert d.find_leaks(docs, spark.createDataFrame([], BENCH)).count() == 0


def _found(docs, items):
    entries = []
    for entry, (item, text) in enumerate(items):
        for s in d.segments_of(item, text):
            s.entry = entry
            entries.append(s)
    hits = d.match(d.Index(entries), docs, d.THRESHOLD, d.OVERLAP)
    return {(text, item): (round(q, 2), round(a, 2)) for text, item, _, _, _, q, a in hits}


def test_long_items_need_question_and_answer():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(5_000)]
    filler = " ".join(rng.choices(vocabulary, k=300))
    question, answer = rng.sample(vocabulary, 150), rng.sample(vocabulary, 90)
    item = " ".join(question) + ". " + " ".join(answer) + "."
    docs = [
        f"{filler} {item} {filler}",  # whole
        f"{filler} {' '.join(question)}. {filler}",  # the answer is missing
        f"{filler} {' '.join(answer)}. {filler}",  # the question is missing
        f"{' '.join(answer)} {filler} {filler} {' '.join(question)}",  # both, far apart
        f"{filler} {' '.join(question[:60])} {filler} {' '.join(answer)}",  # one segment of the question
        f"{filler} {' '.join(question[:20])} {filler} {' '.join(answer)}",  # too little of the question
        f"{filler} {' '.join(question)} {filler} {' '.join(answer[:45])}",  # half of the answer
        f"{filler} {' '.join(question[:120])} {filler} {' '.join(answer[10:])}",  # most of both
        filler,
    ]
    got = _found(docs, [(7, item)])
    assert set(got) == {(0, 7), (3, 7), (4, 7), (7, 7)}
    assert got[0, 7] == got[3, 7] == got[4, 7] == (1.0, 1.0) and 0.6 <= got[7, 7][1] < 1.0


def test_long_item_of_one_sentence_and_of_two_texts():
    words = [f"x{i}" for i in range(200)]
    whole, half = " ".join(words), " ".join(words[:90])
    docs = [f"before {whole} behind", f"before {half} behind"]
    docs.append(" ".join(words[:20]))
    assert set(_found(docs, [(1, whole)])) == {(0, 1), (1, 1)}  # a segment of one long sentence is enough
    assert set(_found(docs, [(1, whole), (1, half)])) == {(0, 1), (1, 1)}
    assert set(_found(docs, [(1, half)])) == {(0, 1), (1, 1)}


def test_short_items_are_listed_not_searched(spark):
    items = [(1, "yes"), (2, "Is it so? Yes."), (3, "one two three four five"), (4, None), (5, "?!"), (6, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, "yes, is it so? yes. one two three four five")], "doc_id long, text string")
    assert {r["item_id"] for r in d.find_leaks(docs, bench).collect()} == {3}
    assert {r["item_id"] for r in d.short_items(bench).collect()} == {1, 2, 4, 5, 6}
    assert d.without_leaks(docs, bench.filter("item_id <> 3")).count() == 1
