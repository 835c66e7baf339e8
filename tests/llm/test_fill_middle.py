"""Fill-in-middle: block tree against plain counting, exact round trip, shares."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cyclewise.llm import fill_middle
from cyclewise.llm.fill_middle import BlockTree, Plan, cut
from tests.llm.edge import edge_docs

STARTS = {
    "char": lambda t: list(range(len(t))),
    "word": lambda t: [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)],
    "line": lambda t: [m.start() for m in re.finditer(r"(?:(?<=\n)|\A)(?s:.)", t)],
}


@pytest.mark.parametrize("unit", sorted(STARTS))
@pytest.mark.parametrize("block", [1, 3, 8, 64, 4096])
def test_boundaries_equal_plain_counting(unit, block):
    rng = random.Random(block)
    for _ in range(60):
        text = "".join(rng.choice("ab é€😀\n\t  ") for _ in range(rng.randint(0, 120)))
        data = text.encode()
        starts = STARTS[unit](text)
        tree = BlockTree(data, unit, block)
        assert (tree.units, tree.chars) == (len(starts), len(text))
        for k in range(len(starts) + 1):
            at = 0 if k == 0 else len(text) if k == len(starts) else starts[k]
            assert tree.boundary(k) == (len(text[:at].encode()), at)


def test_long_text_keeps_blocks_only():
    data = ("wörd " * 400_000).encode()
    tree = BlockTree(data)
    assert len(tree.tree) == -(-len(data) // fill_middle.BLOCK) + 1
    assert tree.boundary(1_234_567) == (len(("wörd " * 400_000)[:1_234_567].encode()), 1_234_567)


@pytest.mark.parametrize("unit", sorted(STARTS))
def test_round_trip_and_forms(spark, unit):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab<PSM >é😀\n") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += ["<P>", "a<S>b", "<M>", "<<P", "<P<S<M", "S>", ">"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plan = Plan(unit=unit)
    rows = fill_middle.transform(docs, plan).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    forms = {"plain": 0, "psm": 0, "spm": 0}
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["back"] == text and r["n"] == len(STARTS[unit](text))
        marked = any(m in text for m in fill_middle.MARKS)
        forms[r["form"]] += 1
        if marked or not text:
            assert r["form"] == "plain"
        if r["form"] == "plain":
            assert r["output"] == text and r["prefix_chars"] is None and r["middle_chars"] is None
        else:
            p, m = r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]
            parts = {"P": text[:p], "M": text[p:m], "S": text[m:]}
            order = "PSM" if r["form"] == "psm" else "SPM"
            assert r["output"] == "".join(f"<{x}>{parts[x]}" for x in order)
    assert all(forms.values()) and forms["psm"] > forms["spm"]


def test_shares_follow_the_plan():
    data = b"some text"
    assert {cut(i, data, Plan(plain_percent=100))[1] for i in range(50)} == {"plain"}
    assert {cut(i, data, Plan(plain_percent=0, suffix_first_percent=100))[1] for i in range(50)} == {"spm"}
    assert cut(7, data, Plan(seed=1)) != cut(7, data, Plan(seed=2))


def test_edge_rows(spark):
    docs = edge_docs(spark).withColumn("form", F.lit(1)).withColumn("output", F.lit("x"))
    out = fill_middle.digests(fill_middle.transform(docs))
    rows = out.collect()
    assert len(rows) == docs.count() and dict(out.dtypes)["doc_id"] == "bigint"
    assert {r["form"] for r in rows if r["n"] == 0} == {"plain"}
    assert fill_middle.transform(docs.limit(0)).count() == 0
    one = [r for r in rows if r["doc_id"] == 1]
    assert len(one) == 2 and one[0] == one[1]
