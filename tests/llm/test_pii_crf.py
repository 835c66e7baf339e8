"""Personal data: patterns against plain regular expressions, the field against exhaustive search."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.llm import pii_crf, queries
from tests.llm.edge import edge_docs


@pytest.fixture(scope="module")
def model():
    return pii_crf.fit(pii_crf.labelled_rows())


def _luhn(digits):
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[::-2]) + sum(t // 10 + t % 10 for t in twice)) % 10 == 0


def brute(text):
    """The contract's patterns as they stand, searched by the regular expression engine."""
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m)) <= 19 and _luhn(digits(m)):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_patterns_equal_plain_search():
    rng = random.Random(5)
    pieces = ["a", "b.", "@", "x@y", ".c", "-", "_", "%", "+", "+1 ", "4", "255", "256", ".", " ", "(", ")", "é", "😀", "00",
              "4111111111111111", "1.2.3.4", "a@b.c", "007.1.", "\n", "5500-0000 0000 0004"]
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert pii_crf.base_spans(text) == brute(text), text
        found += len(brute(text))
    assert found > 5_000


@pytest.mark.parametrize("piece", ["a", "a.", "@", "a@", "a@b", "1", "1.", "1 ", "+1", "+1 ", "1:", "::", "at ", "at dot ", "[at]", " @ ", "(1", "at  "])
def test_hostile_texts_take_linear_time(piece, model):
    text = piece * (400_000 // len(piece))
    started = time.perf_counter()
    pii_crf.base_spans(text)
    pii_crf.windows(text, [])
    assert time.perf_counter() - started < 6


def test_viterbi_and_marginals_equal_exhaustive_search():
    rng = np.random.default_rng(3)
    moves = rng.normal(size=(pii_crf.K + 1, pii_crf.K)) + pii_crf.transitions_allowed()
    tables = [rng.normal(size=(n, pii_crf.K)) for n in (1, 3, 4)]
    scores, lengths = pii_crf._padded(tables)
    paths = pii_crf.viterbi(scores, lengths, moves)
    totals, single, _ = pii_crf.marginals(scores, lengths, moves)
    for i, t in enumerate(tables):
        every = {}
        for path in itertools.product(range(pii_crf.K), repeat=len(t)):
            score = moves[pii_crf.K, path[0]] + sum(t[k, y] for k, y in enumerate(path))
            every[path] = score + sum(moves[a, b] for a, b in zip(path, path[1:]))
        assert tuple(paths[i]) == max(every, key=every.get)
        top = max(every.values())
        weights = {p: np.exp(s - top) for p, s in every.items()}
        assert totals[i] == pytest.approx(top + np.log(sum(weights.values())))
        share = sum(w for p, w in weights.items() if p[0] == 1) / sum(weights.values())
        assert single[i, 0, 1] == pytest.approx(share)


def test_gradient_step_raises_the_likelihood():
    rows = pii_crf.labelled_rows(2)

    def likelihood(model):
        total = 0.0
        for text, spans in rows:
            words = [m[0] for m in pii_crf._WORD.finditer(text)]
            begins = [m.start() for m in pii_crf._WORD.finditer(text)]
            labels = pii_crf._labels(words, begins, spans)
            table = model.rows(words)
            own = model.moves[pii_crf.K, labels[0]] + sum(table[i, y] for i, y in enumerate(labels))
            own += sum(model.moves[a, b] for a, b in zip(labels, labels[1:]))
            total += own - pii_crf.marginals(*pii_crf._padded([table]), model.moves)[0][0]
        return total

    assert likelihood(pii_crf.fit(rows, 5)) < likelihood(pii_crf.fit(rows, 60)) < 0


def test_unseen_writings_are_found(model):
    rows = pii_crf.labelled_rows(8, seed=4711)
    hit, wanted, clean_hits = {k: 0 for k in pii_crf.KINDS}, {k: 0 for k in pii_crf.KINDS}, 0
    for (text, spans), found in zip(rows, pii_crf.find_all([t for t, _ in rows], model)):
        for kind, lo, hi in spans:
            wanted[kind] += 1
            hit[kind] += any(s[1] < hi and s[2] > lo for s in found)
        clean_hits += not spans and any(s[3] == "field" for s in found)
    assert all(hit[k] >= 0.9 * wanted[k] > 0 for k in hit)
    assert clean_hits <= 0.01 * len(rows)


def test_examples(model):
    text = "Call (743) 555-3824 or write jo.smith [at] mail5 [dot] com, not 2024-01-15 12:30:45. x@y.org"
    got = {(k, text[a:b], m) for k, a, b, m in pii_crf.find_all([text], model)[0]}
    assert got == {
        ("phone", "(743) 555-3824", "field"),
        ("email", "jo.smith [at] mail5 [dot] com", "field"),
        ("email", "x@y.org", "pattern"),
    }
    assert pii_crf.masked(text, pii_crf.find_all([text], model)[0]).startswith("Call [phone] or write [email], not 2024")


def test_a_table_can_replace_the_rule(spark):
    rows = [(t, [{"kind": k, "start": a, "end": b} for k, a, b in s]) for t, s in pii_crf.labelled_rows(3)]
    rows += [(None, []), ("", []), ("no span", None)]
    labelled = spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:long,end:long>>")
    learned = pii_crf.learn(labelled)
    assert [s[0] for s in pii_crf.find_all(["ring (743) 555-3824 soon"], learned)[0]] == ["phone"]
    assert pii_crf.find_all(["ring (743) 555-3824 soon"], pii_crf.learn(labelled.limit(0)))[0] == []


def _digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_query_equals_brute_force(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    some = 0
    for r in rows:
        base = brute(docs[r["doc_id"]] or "")
        some += len(base)
        assert r["base_sha256"] == _digest(base)
        for kind in pii_crf.KINDS:
            assert r[f"n_{kind}"] == sum(s[0] == kind for s in base)
        listed = [s for s in r["spans"].split(",") if s]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(listed)
        places = [(pii_crf.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in listed]
        assert places == sorted(places)
    assert some > 0


def test_edge_rows(spark, model):
    docs = edge_docs(spark).withColumn("spans", F.lit(1)).withColumn("masked", F.lit("x"))
    out = pii_crf.find(docs, model, mask=True)
    assert out.columns == ["doc_id", "spans", "masked"] and dict(out.dtypes)["doc_id"] == "bigint"
    rows = out.collect()
    assert len(rows) == docs.count() and all(r["spans"] == [] for r in rows)
    assert sorted(str(r["masked"]) for r in rows) == sorted(r["text"] or "" for r in docs.collect())
    assert pii_crf.digests(pii_crf.find(docs.limit(0), model)).count() == 0
    empty = pii_crf.digests(pii_crf.find(docs.filter("doc_id = 2"), model)).first()
    assert empty["spans"] == "" and empty["base_sha256"] == hashlib.sha256(b"").hexdigest()
