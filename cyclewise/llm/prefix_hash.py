"""Document fingerprints from prefix polynomial hashes.

Every text gets modular prefix arrays of its code points: ``P[k]`` is the polynomial hash
of the first ``k`` characters. Two primes make a pair of arrays. From them any two spans
are compared in constant time, longest common extensions are found by binary search, and
the hash of a spliced text follows from the arrays of its parts without reading it again.

A fingerprint is the length and the hash of the whole text. Likeness of two texts is the
Dice coefficient of their sets of span hashes, so moved and inserted parts count. A span
begins at every position and has ``SPAN`` characters, or those left to the end of the text:
texts of every length are compared in the same way and with all their spans. Two empty texts
are alike, an empty one is unlike any other.

Neighbours in id order. Ids are cut into ranges at quantiles; the first document of a range
also goes, marked, to the range before, so one shuffle and a sort inside partitions give
each document its successor. A task streams over its rows and keeps two texts at a time.

Defined results: a null text counts as empty; null ids come first in the order; repeated
ids follow each other in the order of a text hash; a single document is its own successor;
an empty table gives an empty table. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import partitions_of, prepare

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (911_382_323, 972_663_749)
SPAN = 32
NULL_ID = -(1 << 63)

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, prefix_next long, suffix_next long"
)

_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """``base ** i % prime`` for ``i < n`` at least; grown by doubling and kept in the process."""
    table = _powers.get((base, prime))
    if table is None:
        table = np.ones(1, np.uint64)
    while len(table) < n:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), prime)) % np.uint64(prime)])
    _powers[base, prime] = table
    return table


class Prefix:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        self.text = text
        self.n = len(text)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.sums = []
        for base, prime in zip(BASES, PRIMES):
            p = np.uint64(prime)
            terms = points * powers(base, prime, self.n)[: self.n] % p
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % p]))

    def span(self, which: int, begin: int, end: int) -> int:
        """Hash of a span, still shifted by the power of its begin."""
        return int(self.sums[which][end]) - int(self.sums[which][begin])

    def equal(self, i: int, other: Prefix, j: int, length: int) -> bool:
        """Whether ``length`` characters from ``i`` here and from ``j`` there are the same."""
        for which, (base, prime) in enumerate(zip(BASES, PRIMES)):
            table = powers(base, prime, max(i, j) + 1)
            here = self.span(which, i, i + length) * int(table[j])
            there = other.span(which, j, j + length) * int(table[i])
            if (here - there) % prime:
                return False
        return True

    def extension(self, i: int, other: Prefix, j: int) -> int:
        """Length of the longest common extension to the right of ``i`` and ``j``."""
        lo, hi = 0, min(self.n - i, other.n - j)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(i, other, j, mid) else (lo, mid - 1)
        return lo

    def extension_back(self, i: int, other: Prefix, j: int) -> int:
        """The same to the left of ``i`` and ``j``."""
        lo, hi = 0, min(i, j)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(i - mid, other, j - mid, mid) else (lo, mid - 1)
        return lo

    def whole(self) -> list[int]:
        return [int(s[self.n]) for s in self.sums]


def _placed(begins: list[np.ndarray], ends: list[np.ndarray], at: np.ndarray | slice, n: int) -> np.ndarray:
    """Span hashes from both prefix sums at begins and ends, divided by the powers of the begins; 62 bits."""
    both = np.zeros(len(begins[0]), np.uint64)
    for base, p, low, high in zip(BASES, PRIMES, begins, ends):
        prime, inverse = np.uint64(p), powers(pow(base, -1, p), p, n)[at]
        both = (both << np.uint64(31)) | ((high + prime - low) % prime * inverse % prime)
    return both


def span_hashes(sums: list[np.ndarray]) -> np.ndarray:
    """Hashes of the spans at all positions, free of their place."""
    n = len(sums[0]) - 1
    ends = np.minimum(np.arange(n) + SPAN, n)
    return _placed([s[:n] for s in sums], [s[ends] for s in sums], slice(0, n), n)


def spliced_hashes(left: _Document, keep: int, right: _Document, given: int) -> np.ndarray:
    """The same for ``keep`` characters of one text followed by ``given`` of another.

    Spans inside either part are known; only those over the seam and at the new end are made.
    """
    size, own, other = keep + given, max(0, keep - SPAN + 1), max(0, given - SPAN + 1)
    at = np.concatenate([np.arange(own, keep), np.arange(keep + other, size)])
    ends = np.minimum(at + SPAN, size)
    begins_of, ends_of = [], []
    for base, p, a, b in zip(BASES, PRIMES, left.prefix.sums, right.prefix.sums):
        prime, shift = np.uint64(p), powers(base, p, keep + 1)[keep]
        for places, out in ((at, begins_of), (ends, ends_of)):
            behind = (a[keep] + shift * b[np.maximum(places - keep, 0)] % prime) % prime
            out.append(np.where(places > keep, behind, a[np.minimum(places, keep)]))
    return np.concatenate([left.spans[:own], _placed(begins_of, ends_of, at, size), right.spans[:other]])


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Ascending, each once."""
    ordered = np.sort(hashes)
    fresh = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    return ordered[fresh]


def fingerprint(n: int, hashes: list[int]) -> str:
    return f"{n:x}-{hashes[0]:08x}{hashes[1]:08x}"


def dice(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two ascending arrays of distinct hashes; 1 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    merged = np.concatenate([a, b])
    merged.sort(kind="stable")  # merges the two runs
    return 2.0 * int(np.count_nonzero(merged[1:] == merged[:-1])) / len(merged)


class _Document:
    def __init__(self, doc_id, text: str):
        self.doc_id = doc_id
        self.prefix = Prefix(text)
        self.spans = span_hashes(self.prefix.sums)
        self.set = distinct(self.spans)

    def row(self, following: _Document) -> tuple:
        a, b = self.prefix, following.prefix
        n = a.n
        keep = n - n // 2
        given = min(n // 2, b.n)
        size = keep + given
        edited = [
            (int(a.sums[k][keep]) + int(powers(BASES[k], PRIMES[k], keep + 1)[keep]) * int(b.sums[k][given])) % PRIMES[k]
            for k in range(2)
        ]
        near_edited = dice(self.set, distinct(spliced_hashes(self, keep, following, given)))
        near_next = dice(self.set, following.set)
        front, back = a.extension(0, b, 0), a.extension_back(n, b, b.n)
        digest = hashlib.sha256((a.text[:keep] + b.text[:given]).encode("utf-8", "surrogatepass")).hexdigest()
        return (
            self.doc_id, n, digest, fingerprint(n, a.whole()), fingerprint(size, edited),
            near_edited, near_next, front, back,
        )


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of range, mark and id; each document meets the row behind it."""
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    last, place = None, None
    for frame in frames:
        rows = []
        for at, marked, doc_id, text in zip(frame["place"], frame["marked"], frame["doc_id"], frame["text"]):
            if at != place:
                last, place = None, at
            if marked and last is None:
                continue  # only the first marked row is a successor
            document = _Document(None if pd.isna(doc_id) else int(doc_id), text)
            if last is not None:
                rows.append(last.row(document))
            last = None if marked else document
        if rows:
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows by range of ids, the first of each range also marked behind the range before."""
    spark = docs.sparkSession
    parts = partitions_of(spark)
    ids = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("at"))
    cuts = sorted(set(ids.approxQuantile("at", [k / parts for k in range(1, parts)], 0.2 / parts)))
    cuts = [int(c) for c in cuts]
    place = F.lit(0)
    if cuts:
        bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
        place = F.size(F.filter(bounds, lambda c: c <= F.col("at")))
    firsts = {r["place"]: r["first"] for r in ids.groupBy(place.alias("place")).agg(F.min("at").alias("first")).collect()}
    order = sorted(firsts)
    known = F.create_map(*[F.lit(x) for p in order for x in (p, firsts[p])]) if order else F.create_map()
    before = F.create_map(*[F.lit(x) for k, p in enumerate(order) for x in (p, order[k - 1])]) if order else F.create_map()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("at"),
    ).withColumn("own", place)
    if not order:
        return rows.select("doc_id", "text", F.col("own").alias("place"), F.lit(False).alias("marked"))
    first = known[F.col("own")] == F.col("at")
    targets = F.array(F.struct(F.col("own").alias("place"), F.lit(False).alias("marked")))
    also = F.array(F.struct(before[F.col("own")].alias("place"), F.lit(True).alias("marked")))
    rows = rows.withColumn("to", F.explode(F.when(first, F.concat(targets, also)).otherwise(targets)))
    rows = rows.select("doc_id", "text", "at", "to.place", "to.marked")
    dealt = rows.repartitionById(max(order) + 1, F.col("place"))
    return dealt.sortWithinPartitions("place", "marked", "at", F.xxhash64("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and likeness to it and to the next text."""
    prepare(docs.sparkSession)
    ordered = _in_order(docs).select("doc_id", "text", "place", "marked")
    return ordered.mapInPandas(_walk, SCHEMA)
