"""Near-duplicate groups by DartMinHash signatures.

A text is the multiset of its shingles; the weight of a shingle is its count. Darts are
thrown by hashing: every unit of weight of a shingle is a region along which darts arrive
with exponential gaps of rank, the same for that region in every text. Each dart hits one of
``COORDINATES`` coordinates, and a coordinate keeps the dart of lowest rank. A text throws
darts only up to a rank that depends on its total weight, about
``k ln k + 4k`` darts whatever its length, and twice as far while a coordinate is empty. Two
texts agree in a coordinate with the probability of their weighted Jaccard similarity.

``ROWS`` coordinates make a band. Texts with an equal band share a bucket. In a bucket all
texts are compared with one hub, the text that shares buckets with most others, by the exact
similarity of the whole texts; for a group of edited copies that settles nearly all. A text
in another component than its hub may still be linked to another member. Every open text has
an odd sketch, ``SKETCH_BITS`` parities of its hashed elements: bits that differ between two
sketches are elements that only one of the texts has, so their number bounds the similarity
from above. Pairs of a bucket that this bound allows are joined on ranges of their size and
compared exactly; it never drops a link. Groups are the connected components of the links.

Exact copies are one node from the start, so they cost no comparisons. No task gathers a
bucket: hubs, sizes and element counts are aggregates, members meet their hub in a join.

Defined results: a null text or a null id belongs to no group (``class_id`` null); texts
without a word are linked to equal texts only; repeated rows have the class of their text;
rows with the same id and different texts share a class; an empty table gives an empty
table. Only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import partitions_of, prepare, slices, stored
from cyclewise.llm.components import components
from cyclewise.llm.shingles import U64, elements, mix

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 4
COORDINATES = BANDS * ROWS
#: Nodes compared with a hub in one part, and width of a range of sizes (logarithmic).
HUB_NODES = 256
SIZE_STEP = 0.02
SKETCH_BITS = 1024
SKETCH = [f"s{k}" for k in range(SKETCH_BITS // 64)]


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(11)).astype(np.float64) + 1) * 2.0**-53


def signatures(values: np.ndarray, counts: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Signatures (texts x coordinates) of weighted sets given by their elements."""
    texts = len(counts)
    out = np.zeros((texts, coordinates), U64)
    darts = coordinates * (math.log(coordinates) + 4)
    owner = np.repeat(np.arange(texts), counts)
    reach = darts / np.maximum(counts, 1)
    open_texts = counts > 0
    while open_texts.any():
        use = open_texts[owner]
        best, which = _throw(values[use], owner[use], reach, texts, coordinates)
        done = open_texts & np.isfinite(best).all(1)
        out[done] = which[done]
        open_texts = open_texts & ~done
        reach = reach * 2
    return out


def _throw(values, owner, reach, texts, coordinates) -> tuple[np.ndarray, np.ndarray]:
    """Lowest rank, and its dart, per text and coordinate, up to the reach of each text."""
    best = np.full(texts * coordinates, np.inf)
    which = np.zeros(texts * coordinates, U64)
    rank = np.zeros(len(values))
    limit = reach[owner]
    turn = 0
    while len(values):
        turn += 1
        dart = mix(values + U64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        rank = rank - np.log(_uniform(dart))
        hit = rank <= limit
        values, owner, rank, limit, dart = values[hit], owner[hit], rank[hit], limit[hit], dart[hit]
        aim = mix(dart ^ U64(0xA0761D6478BD642F))
        cell = owner * coordinates + (aim % U64(coordinates)).astype(np.int64)
        np.minimum.at(best, cell, rank)
        first = best[cell] == rank
        which[cell[first]] = aim[first]
    return best.reshape(texts, coordinates), which.reshape(texts, coordinates)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """Band keys (texts x bands) as signed 64-bit numbers."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = list(frame["text"])
        bands: list[list[int]] = []
        for lo, hi in slices([len(t) for t in texts]):
            values, counts = elements(texts[lo:hi], SHINGLE)
            keys = bands_of(signatures(values, counts))
            bands += [k.tolist() if n else [] for k, n in zip(keys, counts)]
        yield pd.DataFrame({"doc_id": frame["doc_id"], "copy_key": frame["copy_key"], "bands": bands})


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets given by their elements."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else 0.0


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        left, right = list(frame["hub_text"]), list(frame["text"])
        found: list[float] = []
        known: tuple[str, np.ndarray] = ("", np.zeros(0, U64))
        for lo, hi in slices([len(t) for t in right]):
            values, counts = elements(right[lo:hi], SHINGLE)
            at = np.concatenate([[0], np.cumsum(counts)])
            for k in range(lo, hi):
                if known[0] != left[k]:
                    known = left[k], elements([left[k]], SHINGLE)[0]
                found.append(similarity(known[1], values[at[k - lo] : at[k - lo + 1]]))
        yield pd.DataFrame({"hub": frame["hub"], "node": frame["node"], "likeness": found})


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Similarity of (hub, node) pairs.

    A hub with many nodes is dealt out in parts of about ``HUB_NODES`` nodes, so member texts
    travel once per pair and hub texts once per part.
    """
    spark = texts.sparkSession
    parts = F.ceil(F.col("nodes") / HUB_NODES)
    many = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("nodes"))
    dealt = stored(
        pairs.join(many, "hub").select("hub", "node", F.pmod(F.xxhash64("node"), parts).alias("part")), "pairs"
    )
    hubs = texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"))
    hubs = dealt.select("hub", "part").distinct().join(hubs, "hub")
    tasks = 2 * partitions_of(spark)
    left = dealt.join(texts, "node").repartition(tasks, "hub", "part")
    both = left.join(hubs.repartition(tasks, "hub", "part"), ["hub", "part"])
    both = both.select("hub", "node", "hub_text", "text")
    return both.mapInPandas(_compare, "hub long, node long, likeness double")


def _with_hubs(rows: DataFrame) -> DataFrame:
    """Rows (bucket, node) of buckets with two or more nodes, with the hub of the bucket."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = stored(rows.join(sizes, "bucket"), "buckets")
    shares = shared.groupBy("node").agg(F.sum("members").alias("shares"))
    ranked = shared.join(shares, "node")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("shares", (-F.col("node")).alias("other"))).alias("top"))
    hubs = hubs.select("bucket", (-F.col("top.other")).alias("hub"))
    return stored(shared.select("bucket", "node").join(hubs, "bucket"), "hubs")


def odd_sketches(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parities of the elements in ``SKETCH_BITS`` cells, packed in signed 64-bit words, per text."""
    owner = np.repeat(np.arange(len(counts)), counts)
    cell = (mix(values ^ U64(0x8CB92BA72F3D8DD7)) >> U64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(owner * SKETCH_BITS + cell, minlength=len(counts) * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(">i8").astype(np.int64).reshape(len(counts), -1)


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = list(frame["text"])
        for lo, hi in slices([len(t) for t in texts]):
            values, counts = elements(texts[lo:hi], SHINGLE)
            out = pd.DataFrame(odd_sketches(values, counts), columns=SKETCH)
            out.insert(0, "node", frame["node"].to_numpy()[lo:hi])
            out.insert(1, "size", counts)
            yield out


def _apart(rows: DataFrame, found: DataFrame, other: str) -> DataFrame:
    """Rows whose ``node`` and ``other`` are in different components, with both components."""
    labels = components(found.select(F.col("hub").alias("a"), F.col("node").alias("b")))
    mine = labels.select("node", F.col("component").alias("own_class"))
    theirs = labels.select(F.col("node").alias(other), F.col("component").alias("other_class"))
    out = rows.join(mine, "node", "left").join(theirs, other, "left")
    out = out.withColumn("own_class", F.coalesce("own_class", "node"))
    return out.withColumn("other_class", F.coalesce("other_class", other)).filter("own_class != other_class")


def _size_bin(size: Column) -> Column:
    return F.floor(F.log(F.greatest(size, F.lit(1))) / SIZE_STEP).cast("int")


def _possible_pairs(asks: DataFrame, offers: DataFrame, least: float) -> DataFrame:
    """Pairs of one bucket and two components that sizes and sketches allow to be linked."""
    own = [F.col(c).alias(f"own_{c}") for c in SKETCH]
    asks = asks.select("bucket", F.col("node").alias("own"), F.col("size").alias("own_size"), "own_class", *own)
    low, high = F.col("own_size") * least, F.col("own_size") / least
    asks = asks.withColumn("bin", F.explode(F.sequence(_size_bin(low - 1), _size_bin(high + 1))))
    differ = " + ".join(f"bit_count({c} ^ own_{c})" for c in SKETCH)
    both = (1 - least) / (1 + least)  # n + m - 2 * common, by n + m, of a pair just linked
    fits = F.expr(f"class <> own_class AND {differ} <= (own_size + size) * {both} + 1e-6")
    pairs = asks.join(offers.withColumn("bin", _size_bin(F.col("size"))), ["bucket", "bin"]).filter(fits)
    return pairs.select(F.col("node").alias("hub"), F.col("own").alias("node")).distinct()


def links(texts: DataFrame, banded: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links (a, b) that connect all texts in shared buckets whose similarity is ``least`` or more.

    ``texts`` has ``node, text``, ``banded`` has ``node, bands``.
    """

    def linked(pairs: DataFrame) -> DataFrame:
        return stored(_compared(pairs, near).filter(F.col("likeness") >= least), "links")

    members = _with_hubs(banded.select("node", F.explode("bands").alias("bucket")))
    near = stored(texts.join(members.select("node").distinct(), "node"), "texts")
    found = linked(members.filter("node != hub").select("hub", "node").distinct())
    open_rows = stored(_apart(members, found, "hub").select("bucket", "node", "own_class"), "open")
    if not open_rows.isEmpty():
        rows = members.join(open_rows.select("bucket").distinct(), "bucket").select("bucket", "node")
        kinds = "node long, size long, " + ", ".join(f"{c} long" for c in SKETCH)
        sketches = near.join(rows.select("node").distinct(), "node").mapInPandas(_sketch, kinds)
        labels = components(found.select(F.col("hub").alias("a"), F.col("node").alias("b")))
        sketches = stored(
            sketches.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component"),
            "sketches",
        )
        pairs = _possible_pairs(open_rows.join(sketches, "node"), rows.join(sketches, "node"), least)
        found = found.unionByName(linked(pairs))
    return found.select(F.col("hub").alias("a"), F.col("node").alias("b"))


def groups(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id`` (smallest id of the group) of every document."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    keyed = whole.withColumn("copy_key", F.md5(F.col("text").cast("binary")))
    signed = stored(keyed.mapInPandas(_sign, "doc_id long, copy_key string, bands array<long>"), "signatures")
    nodes = stored(
        signed.groupBy("copy_key").agg(
            F.min("doc_id").alias("node"), F.first("bands").alias("bands")
        ),
        "nodes",
    )
    banded = nodes.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("bands"))).alias("bands")
    )
    found = links(whole.select(F.col("doc_id").alias("node"), "text"), banded, least)
    labels = components(found)
    named = signed.select("doc_id", "copy_key").join(nodes.select("copy_key", "node"), "copy_key")
    classes = named.join(labels, "node", "left").select("doc_id", F.coalesce("component", "node").alias("class_id"))
    rest = rows.filter("doc_id IS NULL OR text IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return classes.unionByName(rest)


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Rows of ``docs`` with the smallest id of their group; rows of no group stay.

    Of repeated rows with that id one stays.
    """
    classes = groups(docs, least)
    known = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    gone = classes.filter("doc_id != class_id").select("doc_id").distinct()
    kept = known.join(gone, "doc_id", "left_anti")
    again = stored(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "again")
    if not again.isEmpty():
        once = kept.join(again, "doc_id").select(docs.columns).dropDuplicates(["doc_id"])
        kept = kept.join(again, "doc_id", "left_anti").unionByName(once)
    return kept.select(docs.columns).unionByName(docs.filter("doc_id IS NULL OR text IS NULL"))
