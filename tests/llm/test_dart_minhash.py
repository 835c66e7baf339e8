"""DartMinHash groups against all pairs, signatures against weighted Jaccard."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from cyclewise.llm import components, dart_minhash as m
from cyclewise.llm.queries import QUERIES
from cyclewise.llm.shingles import elements
from tests.llm.edge import SCHEMA, edge_docs


def _shingles(text, n=5):
    words = re.findall(r"\w+", text.lower())
    return Counter(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else Counter()


def _likeness(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def _components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def _brute(rows):
    """Class of every (id, text): all pairs of different texts that share a shingle."""
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[text].append(doc_id)
    first = {t: min(i) for t, i in ids.items()}
    sets = {d: _shingles(t) for t, d in first.items()}
    places = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            places[x].add(d)
    pairs = {p for group in places.values() for p in combinations(sorted(group), 2)}
    classes = _components(sets, [p for p in pairs if _likeness(sets[p[0]], sets[p[1]]) >= 0.8])
    return {d: classes[first[t]] for d, t in rows}


def test_query_equals_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op5_near_duplicates"](spark, sf_dir).collect()}
    assert got == _brute([tuple(r) for r in docs.collect()])


def test_groups_of_edited_copies_equal_all_pairs(spark):
    """Large groups of copies, with and without their source, of all degrees of editing."""
    rng = random.Random(8)
    rows = []
    for group, (copies, edits) in enumerate([(120, 2), (120, 4), (60, 8), (5, 1)]):
        base = [f"g{group}w{rng.randint(0, 300)}" for _ in range(120)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + k, rows[k][1]) for k in range(40)]
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in m.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _brute(rows)


def test_signatures_agree_as_often_as_texts_are_alike():
    a = " ".join(["one two three four"] * 5 + [f"w{k}" for k in range(200)])
    b = " ".join(["one two three four"] * 9 + [f"w{k}" for k in range(30, 200)])
    values, counts = elements([a, b, a], 1)
    signature = m.signatures(values, counts, 4096)
    assert (signature[0] == signature[2]).all()
    assert abs((signature[0] == signature[1]).mean() - _likeness(_shingles(a, 1), _shingles(b, 1))) < 0.04


def test_elements_are_the_multiset():
    texts = ["a b a b a b a", "A, b! a b; a b a", "", "...", "one", "äÖ ÄÖ " * 100]
    values, counts = elements(texts, 2)
    assert counts.tolist() == [sum(_shingles(t, 2).values()) for t in texts]
    at = np.concatenate([[0], np.cumsum(counts)])
    assert set(values[: at[1]]) == set(values[at[1] : at[2]]) and len(set(values[: at[1]])) == 6


def test_sketches_never_hide_a_link():
    rng = random.Random(1)
    for n in (1, 10, 200, 5_000):
        a = list(rng.choices(range(10**9), k=n))
        b = [x if rng.random() > 0.1 else rng.randrange(10**9) for x in a]
        sets = [np.unique(np.array(x, np.uint64)) for x in (a, b)]
        sketches = m.odd_sketches(np.concatenate(sets), np.array([len(s) for s in sets]))
        differ = sum(bin(int(x) & (2**64 - 1)).count("1") for x in sketches[0] ^ sketches[1])
        assert differ <= len(set(sets[0].tolist()) ^ set(sets[1].tolist()))


def test_components_of_paths_and_stars(spark):
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, 1001 + k) for k in range(50)] + [(7, 7), (2000, 1500)]
    edges += [(rng.randint(3000, 3100), rng.randint(3000, 3100)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    edges = [e for e in edges if e[0] != e[1]]
    want = _components({x for e in edges for x in e}, edges)
    assert {n: c for n, c in want.items()} == got


def test_edge_rows(spark):
    got = sorted(((str(r["doc_id"]), r["class_id"]) for r in m.groups(edge_docs(spark)).collect()), key=str)
    assert got == sorted(
        [("1", 1), ("1", 1), ("2", None), ("3", 3), ("4", 4), ("None", None), ("None", None), ("5", 5), ("6", 6), ("7", 7), ("8", 8)],
        key=str,
    )
    assert m.groups(spark.createDataFrame([], SCHEMA)).count() == 0
