"""Filter audit: least squares against the definition, rows against filters applied one by one."""

from __future__ import annotations

import math
import random
import re
from fractions import Fraction
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from cyclewise.llm import filter_audit
from tests.llm.edge import edge_docs

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("n", [2, 3, 5])
def test_least_squares_equal_shapley_values(n):
    rng = random.Random(n)
    operator = filter_audit.shapley_operator(n)
    for _ in range(5):
        worth = [0] + [rng.randint(-50, 50) for _ in range(2**n - 1)]
        direct = [Fraction(0)] * n
        for order in permutations(range(n)):
            before = 0
            for i in order:
                direct[i] += Fraction(worth[before | 1 << i] - worth[before], math.factorial(n))
                before |= 1 << i
        assert [sum(w * v for w, v in zip(row, worth)) for row in operator] == direct


def brute(docs, labels):
    """Every order applied step by step to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    facts = []
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": any(c in text for c in "#$%&*|"),
            "E": doc_id is not None
            and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in docs),
        }
        facts.append((source or "", {f for f, x in fails.items() if x}, doc_id in good, doc_id in toxic))
    out = {}
    for part in {f[0] for f in facts}:
        inside = [f for f in facts if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = inside
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                out[part, order, step] = [
                    len(left), len(gone), sum(letter in f[1] for f in inside) - len(gone),
                    sum(f[1] == {letter} for f in inside), sum(f[2] for f in gone), sum(f[3] for f in gone),
                ]
    totals = {}
    for (part, order, step), row in out.items():
        key = part, order[step - 1]
        totals[key] = totals.get(key, 0) + row[1]
    return {k: [*row, totals[k[0], k[1][k[2] - 1]]] for k, row in out.items()}


def _check(spark, docs, labels):
    rows = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    want = brute(docs, labels)
    got = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in rows}
    assert got == want and len(rows) == len(want)


def test_rows_equal_filters_one_by_one(spark):
    rng = random.Random(1)
    vocabulary = ["word", "Ünï", "ABC", "x#y", "plain", "a b", "tea\x0bcup", "50%"]
    texts = []
    for _ in range(40):
        kinds = rng.sample(vocabulary[:4], rng.randint(1, 2))
        size = rng.choice([3, 150, 199, 200, 201, 260])
        clean = [f"w{i}" if rng.random() < 0.8 else "again" for i in range(size)]
        texts.append(rng.choice([" ", "\n", "\t ", "\x0b"]).join(clean + rng.choice([[], kinds])))
    texts += [" ".join(["rep"] * 250), "", None, " \t\r\n"]
    docs = [(i, rng.choice(texts), rng.choice(["s0", "s0", "s1", "s2", None, ""])) for i in range(1, 260)]
    docs += [(5, docs[4][1], "s1"), (5, "other", "s0"), (7, docs[6][1], docs[6][2]), (None, docs[0][1], "s0"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(1, 200, 2)]
    labels += [(3, 1, 0), (3, 0, 1), (None, 1, 1), (999, 1, 1)]
    _check(spark, docs, labels)


def test_clashing_columns_and_empty_tables(spark):
    docs = edge_docs(spark)
    for name in ("mask", "n", "digest", "part", "good", "toxic", "first", "quality", "all", "smallest", "without_id"):
        docs = docs.withColumn(name, F.lit("x"))
    labels = spark.createDataFrame([(1, 1, 1)], LABELS).withColumn("good", F.lit(3)).withColumn("n", F.lit(3))
    plain = [tuple(r) for r in edge_docs(spark).select("doc_id", "text", "source").collect()]
    got = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in filter_audit.audit(docs, labels).collect()}
    assert got == brute(plain, [(1, 1, 1)])
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_other_part_column(spark):
    out = filter_audit.audit(edge_docs(spark), spark.createDataFrame([], LABELS), part="lang")
    assert {r["part"] for r in out.select("part").distinct().collect()} == {"en", "de", ""}
