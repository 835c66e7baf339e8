"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text: each byte adds a table value to the doubled
hash, so the hash at a place depends on the last ``WINDOW`` bytes only. A chunk ends where
this hash is the maximum of ``RADIUS`` places on either side. Borders therefore depend on
nearby content alone, and the chunks behind an insertion are the same as before it; chunks are
more than ``RADIUS`` bytes long, and stretches without a border are cut at ``LONGEST``.

A chunk is repeated if its digest comes in a document of smaller id. Runs of repeated chunks
that hold at least ``RUN_WORDS`` whole words are removed, so the first document keeps the
passage, later ones lose it, and phrases or lines that many texts share stay. Several digests
must agree to make a run, which guards against a chance collision. A passage of over fifty
words is found from any two documents; its first and last words, up to the first and last
common border, stay.

Digests are reduced to first and last document before they are joined back, so a passage in a
third of all documents is one row of that side, and the other side is split by Spark as a
skewed join. The ranges to cut are collected per document, never per digest.

Defined results: null texts and rows with a null id stay as they are and own no passage;
repeats inside one document stay; repeated rows are one document and get the same result; an
empty table gives an empty table. Other columns are kept, and columns named like an output
column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import prepare, slices

WINDOW = 16
RADIUS = 20
LONGEST = 4096
RUN_WORDS = 16

U64 = np.uint64


def _gear_table() -> np.ndarray:
    """256 pseudo-random 32-bit values by rule."""
    x = np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return ((x ^ (x >> U64(31))) >> U64(32)).astype(np.uint32)


GEAR = _gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte over the ``WINDOW`` bytes that end there, by doubling."""
    h = GEAR[data]
    width = 1
    while width < WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    return h


def _window_max(h: np.ndarray, width: int) -> np.ndarray:
    """Maximum of ``h[i : i + width]`` for every full window."""
    m, have = h, 1
    while have < width:
        step = min(have, width - have)
        m = np.maximum(m[:-step], m[step:])
        have += step
    return m


def chunk_borders(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the chunks of texts on end; no chunk spans two texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    cuts = np.zeros(0, np.int64)
    if len(data) > 2 * RADIUS:
        h = gear_hashes(data)
        top = _window_max(h, RADIUS)
        place = np.arange(RADIUS, len(h) - RADIUS)
        peak = np.flatnonzero((h[place] > top[place - RADIUS]) & (h[place] >= top[place + 1])) + RADIUS
        text = np.searchsorted(edges, peak, side="right") - 1
        inside = (peak - RADIUS - WINDOW + 1 >= edges[text]) & (peak + RADIUS < edges[text + 1])
        cuts = peak[inside] + 1
    borders = np.unique(np.concatenate([edges, cuts]))
    long = np.flatnonzero(np.diff(borders) > LONGEST)
    if len(long):
        extra = [np.arange(borders[k] + LONGEST, borders[k + 1], LONGEST) for k in long]
        borders = np.unique(np.concatenate([borders, *extra]))
    return borders[:-1], borders[1:]


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digest = xxhash.xxh3_64_intdigest
    for frame in frames:
        ids, texts = frame["doc_id"].to_numpy(), [t.encode("utf-8", "surrogatepass") for t in frame["text"]]
        for lo, hi in slices([len(t) for t in texts]):
            part = texts[lo:hi]
            begin, end = chunk_borders(part)
            view = memoryview(b"".join(part))
            edges = np.concatenate([[0], np.cumsum([len(t) for t in part])])
            text = np.searchsorted(edges, begin, side="right") - 1
            checks = np.array([zlib.crc32(t) for t in part], np.int64)
            base = edges[text]
            yield pd.DataFrame(
                {
                    "digest": np.array([digest(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())], U64).view(np.int64),
                    "doc_id": ids[lo:hi][text],
                    "text_check": checks[text],
                    "place": ((begin - base) << 32) | (end - base),
                }
            )


def _merged(places: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of chunks that follow each other; chunks given as begin and end in one number, ascending."""
    run: list[int] | None = None
    for p in places:
        a, b = p >> 32, p & 0xFFFFFFFF
        if run and a <= run[1]:
            run[1] = max(run[1], b)
        else:
            if run:
                yield run[0], run[1]
            run = [a, b]
    if run:
        yield run[0], run[1]


SPACE = frozenset(b" \t\n\r\x0b\x0c")


def _whole_words(data: bytes, a: int, b: int) -> tuple[int, int]:
    """The part of a range that begins and ends with whole words."""
    if a > 0 and data[a - 1] not in SPACE:
        while a < b and data[a] not in SPACE:
            a += 1
    while a < b and data[a] in SPACE:
        a += 1
    if b < len(data) and data[b] not in SPACE:
        while b > a and data[b - 1] not in SPACE:
            b -= 1
    return a, b


def cut(text: str, places: list[int], least: int = RUN_WORDS) -> tuple[str, list[tuple[int, int]]]:
    """Text without its repeated runs, and the removed spans in characters."""
    data = text.encode("utf-8", "surrogatepass")
    kept, spans, at = [], [], 0
    for a, b in _merged(places):
        a, b = _whole_words(data, a, b)
        if len(data[a:b].split()) >= least:
            kept.append(data[at:a])
            begin = len(data[:a].decode("utf-8", "surrogatepass"))
            spans.append((begin, begin + len(data[a:b].decode("utf-8", "surrogatepass"))))
            at = b
    if not spans:
        return text, []
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass"), spans


CUT_TYPE = "struct<text:string,spans:array<struct<begin:int,end:int>>>"


def _cut(text: pd.Series, places: pd.Series) -> pd.DataFrame:
    texts, spans = [], []
    for t, p in zip(text, places):
        new, removed = cut(t, [int(x) for x in p]) if t is not None and p is not None else (t, [])
        texts.append(new)
        spans.append([{"begin": a, "end": b} for a, b in removed])
    return pd.DataFrame({"text": texts, "spans": spans})


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Chunks that a document of smaller id has too: ``doc_id, text_check, place, first_id``."""
    whole = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = whole.mapInPandas(_chunks, "digest long, doc_id long, text_check long, place long")
    owners = chunks.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    owners = owners.filter("first_id < last_id").select("digest", "first_id")
    return chunks.join(owners, "digest").filter("first_id < doc_id").drop("digest")


def dedup(docs: DataFrame) -> DataFrame:
    """Documents with ``text`` freed of passages that an earlier document has.

    Adds ``removed_spans`` (characters of the old text), ``removed_chars`` and ``first_ids``,
    the documents in which repeated chunks of a changed text come first.
    """
    prepare(docs.sparkSession)
    ranges = (
        repeated_chunks(docs)
        .groupBy("doc_id", "text_check")
        .agg(F.array_sort(F.collect_set("place")).alias("places"), F.array_sort(F.collect_set("first_id")).alias("first"))
    )
    # the rows travel as one value, so their columns may have any names
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    matches = (F.col("doc.doc_id") == F.col("doc_id")) & (F.crc32(F.col("doc.text").cast("binary")) == F.col("text_check"))
    joined = packed.join(ranges, matches, "left").withColumn("new", F.pandas_udf(_cut, CUT_TYPE)("doc.text", "places"))
    removed = F.aggregate("new.spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"])
    first = F.when(F.size("new.spans") > 0, F.col("first")).otherwise(F.array().cast("array<long>"))
    added = {"removed_spans": F.col("new.spans"), "removed_chars": removed, "first_ids": first}
    kept = [
        F.col("new.text").alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in added
    ]
    return joined.select(*kept, *[value.alias(c) for c, value in added.items()])
