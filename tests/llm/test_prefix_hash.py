"""Prefix-hash fingerprints against direct string work."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cyclewise.llm import prefix_hash
from tests.llm.edge import SCHEMA, edge_docs


def _edited(rows):
    """(id, text, edited, next text) in id order; repeated ids in the operator's order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        out.append((doc_id, text, text[: len(text) - half] + following[:half], following))
    return out


def _likeness(a, b):
    """Dice coefficient of the sets of all spans, cut off at the end of the text."""
    x, y = ({t[i : i + prefix_hash.SPAN] for i in range(len(t))} for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def _check(got, rows):
    want = {}
    for doc_id, text, edited, following in _edited(rows):
        key = (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest())
        want.setdefault(key, []).append((text, edited, following))
    prints = {}
    for g in got:
        text, edited, following = want[g["doc_id"], g["n_chars"], g["edited_sha256"]].pop()
        for t, f in ((text, g["fingerprint"]), (edited, g["edited_fingerprint"])):
            assert prints.setdefault(t, f) == f
        assert g["near_edited"] == pytest.approx(_likeness(text, edited), abs=1e-9)
        assert g["near_next"] == pytest.approx(_likeness(text, following), abs=1e-9)
        if following == text:
            assert g["near_next"] == 1
        if edited == text:
            assert g["near_edited"] == 1
    assert not any(want.values())
    assert len(set(prints.values())) == len(prints)


def _ordered(df):
    key = [F.coalesce("doc_id", F.lit(prefix_hash.NULL_ID)), F.xxhash64(F.coalesce("text", F.lit("")))]
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").orderBy(*key).collect()]


def test_query_equals_brute_force(spark, sf_dir):
    from cyclewise.llm.queries import QUERIES

    rows = _ordered(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    _check(QUERIES["op4_fingerprints"](spark, sf_dir).collect(), rows)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    _check(prefix_hash.fingerprints(docs).collect(), _ordered(docs))
    one = docs.filter("doc_id = 8")
    assert prefix_hash.fingerprints(one).first()["near_next"] == 1
    assert prefix_hash.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_extensions_equal_direct_comparison():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ("".join(rng.choice("aäb") for _ in range(rng.randint(0, 60))) for _ in range(2))
        x, y = prefix_hash.Prefix(a), prefix_hash.Prefix(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        right = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
        left = next((k for k in range(min(i, j)) if a[i - 1 - k] != b[j - 1 - k]), min(i, j))
        assert x.extension(i, y, j) == right and x.extension_back(i, y, j) == left


def test_spliced_spans_equal_those_of_the_text():
    rng = random.Random(5)
    for n, m in ((100, 90), (40, 300), (64, 5), (33, 0), (500, 500), (0, 9), (1, 9), (7, 3)):
        a, b = ("".join(rng.choice("abcdef ") for _ in range(k)) for k in (n, m))
        x, y = prefix_hash._Document(1, a), prefix_hash._Document(2, b)
        keep, given = n - n // 2, min(n // 2, m)
        wanted = prefix_hash.span_hashes(prefix_hash.Prefix(a[:keep] + b[:given]).sums)
        assert sorted(prefix_hash.spliced_hashes(x, keep, y, given)) == sorted(wanted)
