"""Benchmark decontamination: BM25 retrieval with block-max WAND, then overlap of words.

Index. Benchmark items are cut into segments of at most ``SEGMENT_WORDS`` words. A posting
holds the BM25 impact of a word in a segment, divided by the score the segment has for
itself, so a score of 1 means that a passage holds all its words, and one threshold serves
segments of every length. Postings lie in segment order in blocks with their largest impact.
The benchmark is the small side: its index is built on the driver after its bytes have been
measured against ``MAX_INDEX_BYTES`` and is broadcast; a larger benchmark is split over
several indexes, each asked in a pass of its own.

Queries. Every document is cut into overlapping passages, twice as long as a segment at
least, so each copy of a segment lies in one passage as a whole. Per passage the sum of the
largest impacts of its words is an upper bound for every segment; most passages end there,
by sums over whole arrays. The others run block-max WAND: a pivot segment is found by the
largest impacts, checked against the maxima of the blocks around it, skipped by blocks or
scored. All segments that reach the threshold are retrieved, not the best few.

Verification. The last sentence of an item is its answer, the rest its question; a single
sentence is both. An item of one segment counts if a passage holds at least ``OVERLAP`` of the
word n-grams of its question and of its answer. A longer item of one sentence is cut into
segments that count like items. The question and the answer of any other longer item are cut
apart, so no segment mixes them; the item counts if the document's passages hold at least
``OVERLAP`` of a segment of its question and of all of its answer. Items of fewer than
``LEAST_WORDS`` words say nothing about a leak: they are not searched but listed by
``short_items``.

Defined results: null texts, and items without a word, match nothing; repeated rows give
repeated rows, repeated items one row per item; empty tables give an empty table; other
columns are kept or ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import prepare, slices

K1 = 1.2
B = 0.75
THRESHOLD = 0.6
OVERLAP = 0.6
SEGMENT_WORDS = 64
GRAM = 5
LEAST_WORDS = 5
#: Segments in a block of the index, and of the block table.
BLOCK = 4
TABLE_BYTES = 64 * 1024 * 1024
MAX_INDEX_BYTES = 8 * 1024 * 1024

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
SCHEMA = (
    "doc_id long, item_id long, matches int, first_word int, score double, question_overlap double, "
    "answer_overlap double"
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


@dataclass(eq=False)
class Segment:
    """Words of an item; ``whole`` if it is all of the item, else a part of question or answer."""

    item_id: int
    question: list[str]
    answer: list[str]
    whole: bool = True
    entry: int = 0

    @property
    def words(self) -> list[str]:
        return self.question + self.answer if self.answer is not self.question else self.question


def _pieces(words: list[str]) -> list[list[str]]:
    n = math.ceil(len(words) / SEGMENT_WORDS)
    cuts = [len(words) * k // n for k in range(n + 1)]
    return [words[a:b] for a, b in zip(cuts, cuts[1:])]


def segments_of(item_id: int, text: str) -> list[Segment]:
    """Segments of an item; none for one of fewer than ``LEAST_WORDS`` words."""
    sentences = [w for w in (words_of(s) for s in SENTENCE.split(text)) if w]
    size = sum(map(len, sentences))
    if size < LEAST_WORDS:
        return []
    question, answer = [w for s in sentences[:-1] for w in s], sentences[-1]
    if size <= SEGMENT_WORDS:
        return [Segment(item_id, question or answer, answer)]
    if not question:
        return [Segment(item_id, part, part) for part in _pieces(answer)]
    parts = [Segment(item_id, part, [], False) for part in _pieces(question)]
    return parts + [Segment(item_id, [], part, False) for part in _pieces(answer)]


def short_items(benchmark: DataFrame) -> DataFrame:
    """Items that are too short to be searched, null texts included."""
    few = F.udf(lambda text: sum(len(words_of(s)) for s in SENTENCE.split(text or "")) < LEAST_WORDS, "boolean")
    return benchmark.filter(few("text"))


@dataclass
class Postings:
    """Segments of one word, ascending, with impacts and maxima of blocks."""

    segments: list[int]
    impacts: list[float]
    top: float
    block_top: list[float] = field(default_factory=list)
    block_last: list[int] = field(default_factory=list)

    def __post_init__(self):
        for i in range(0, len(self.segments), BLOCK):
            self.block_top.append(max(self.impacts[i : i + BLOCK]))
            self.block_last.append(self.segments[min(i + BLOCK, len(self.segments)) - 1])


class Index:
    """BM25 index of segments; words are numbered, ``bounds`` holds the largest impact of each."""

    def __init__(self, segments: list[Segment]):
        self.segments = segments
        #: n-grams of the answer of every entry, which is one text of an item.
        self.grams: Counter[int] = Counter()
        for s in segments:
            self.grams[s.entry] += n_grams(s.answer)
        counts = [Counter(s.words) for s in segments]
        seen = Counter(w for c in counts for w in c)
        mean = sum(len(s.words) for s in segments) / max(1, len(segments))
        lists: dict[str, list[tuple[int, float]]] = {}
        for k, (segment, count) in enumerate(zip(segments, counts)):
            size = K1 * (1 - B + B * len(segment.words) / mean)
            impact = {
                w: math.log1p((len(segments) - seen[w] + 0.5) / (seen[w] + 0.5)) * n * (K1 + 1) / (n + size)
                for w, n in count.items()
            }
            own = sum(impact.values())
            for w, x in impact.items():
                lists.setdefault(w, []).append((k, x / own))
        self.number = {w: i for i, w in enumerate(lists)}
        self.postings = [
            Postings([k for k, _ in p], [x for _, x in p], max(x for _, x in p)) for p in lists.values()
        ]
        blocks = -(-len(segments) // BLOCK)
        if 4 * blocks * len(lists) > TABLE_BYTES:
            self.table = np.array([[p.top] for p in self.postings], np.float32)
        else:
            self.table = np.zeros((len(lists), blocks), np.float32)
            for row, p in zip(self.table, self.postings):
                np.maximum.at(row, np.array(p.segments) // BLOCK, p.impacts)
        self.passage = 2 * max((len(s.words) for s in segments), default=1)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All segments with a score of at least ``threshold``, by block-max WAND."""
        found, limit = [], threshold - 1e-9
        lists = [self.postings[t] for t in terms]
        at = [0] * len(lists)
        block = [0] * len(lists)
        live = sorted(range(len(lists)), key=lambda i: lists[i].segments[0])
        while live:
            total, pivot = 0.0, -1
            for place, i in enumerate(live):
                total += lists[i].top
                if total >= limit:
                    pivot = place
                    break
            if pivot < 0:
                break
            target = lists[live[pivot]].segments[at[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]].segments[at[live[pivot + 1]]] == target:
                pivot += 1
            total, nearest = 0.0, len(self.segments)
            for i in live[: pivot + 1]:
                p = lists[i]
                while block[i] < len(p.block_last) and p.block_last[block[i]] < target:
                    block[i] += 1
                if block[i] < len(p.block_last):
                    total += p.block_top[block[i]]
                    nearest = min(nearest, p.block_last[block[i]] + 1)
            if total < limit:  # no segment before the end of the nearest block can reach the threshold
                beyond = live[pivot + 1 : pivot + 2]
                if beyond:
                    nearest = min(nearest, lists[beyond[0]].segments[at[beyond[0]]])
                goal = max(nearest, target + 1)
            else:
                first = lists[live[0]].segments[at[live[0]]]
                goal = target
                if first == target:
                    score = sum(lists[i].impacts[at[i]] for i in live[: pivot + 1])
                    if score >= limit:
                        found.append((target, score))
                    goal = target + 1
            moved = []
            for i in live[: pivot + 1]:
                p, k = lists[i], at[i]
                if p.segments[k] < goal:
                    b = block[i]
                    while b < len(p.block_last) and p.block_last[b] < goal:
                        b += 1
                    block[i], k = b, max(k, b * BLOCK)
                    while k < len(p.segments) and p.segments[k] < goal:
                        k += 1
                    at[i] = k
                if at[i] < len(p.segments):
                    moved.append(i)
            live = sorted(moved + live[pivot + 1 :], key=lambda i: lists[i].segments[at[i]])
        return found


def n_grams(part: list[str]) -> int:
    return len(grams(part, min(GRAM, len(part)))) if part else 0


def overlap(part: list[str], passage: list[str], known: dict[int, set]) -> float:
    """Share of the n-grams of ``part`` that the passage holds."""
    n = min(GRAM, len(part))
    if n not in known:
        known[n] = grams(passage, n)
    own = grams(part, n)
    return len(own & known[n]) / len(own)


def _open_passages(index: Index, ids: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Passages (text, first word) with a block whose maxima reach the threshold.

    ``ids`` are the word numbers of all texts on end. Word ``i`` of a text lies in the
    passages ``i // stride`` and the one before; it counts where it comes first.
    """
    stride = index.passage // 2
    passages = np.maximum(1, -(-(sizes - stride) // stride))
    text_at = np.concatenate([[0], np.cumsum(sizes)])
    passage_at = np.concatenate([[0], np.cumsum(passages)])
    known = np.flatnonzero(ids < len(index.postings))
    text = np.searchsorted(text_at, known, side="right") - 1
    order = np.argsort(ids[known], kind="stable")
    before = np.full(len(known), -1, np.int64)
    same = ids[known][order][1:] == ids[known][order][:-1]
    before[order[1:][same]] = known[order[:-1][same]]
    place = known - text_at[text]
    bound = np.zeros((int(passage_at[-1]), index.table.shape[1]), np.float32)
    for back in (0, 1):
        k = place // stride - back
        begin = text_at[text] + k * stride
        use = np.flatnonzero((k >= 0) & (k < passages[text]) & (before < begin))
        if len(use):
            target = passage_at[text[use]] + k[use]
            first = np.flatnonzero(np.diff(target, prepend=-1))
            bound[target[first]] += np.add.reduceat(index.table[ids[known[use]]], first, axis=0)
    wins = np.flatnonzero(bound.max(1, initial=0.0) >= threshold - 1e-4)
    text = np.searchsorted(passage_at, wins, side="right") - 1
    return np.stack([text, (wins - passage_at[text]) * stride], axis=1)


def match(index: Index, texts: list[str], threshold: float, least: float) -> list[tuple]:
    """(text number, item, matches, first word, score, question and answer overlap) of all items found."""
    if not index.segments or not texts:
        return []
    number, none = index.number, len(index.postings)
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.array([number.get(w, none) for part in words for w in part], np.int64)
    items: dict[tuple[int, int], list] = {}
    parts: dict[tuple[int, int], dict[int, tuple]] = {}

    def keep(text: int, item: int, lo: int, matches: int, found: list[float]) -> None:
        row = items.setdefault((text, item), [0, lo, 0.0, 0.0, 0.0])
        row[0] += matches
        row[2:] = max(row[2:], found)

    for text, lo in _open_passages(index, ids, sizes, threshold).tolist():
        passage = words[text][lo : lo + index.passage]
        known: dict[int, set] = {}
        terms = sorted({number[w] for w in passage if w in number})
        for segment_at, score in index.search(terms, threshold):
            s = index.segments[segment_at]
            shares = [overlap(part, passage, known) if part else 0.0 for part in (s.question, s.answer)]
            if s.whole:
                if min(shares) >= least:
                    keep(text, s.item_id, lo, 1, [score, *shares])
            else:
                best = parts.setdefault((text, s.entry), {})
                best[segment_at] = max(best.get(segment_at, (0.0, 0.0)), (max(shares), score, lo))
    for (text, entry), best in parts.items():
        shares = [0.0, 0.0]
        for segment_at, (share, _, _) in best.items():
            s = index.segments[segment_at]
            if s.question:
                shares[0] = max(shares[0], share)
            else:
                shares[1] += share * n_grams(s.answer) / index.grams[entry]
        if min(shares) >= least:
            item = index.segments[next(iter(best))].item_id
            first = min(lo for _, _, lo in best.values())
            keep(text, item, first, len(best), [max(score for _, score, _ in best.values()), *shares])
    return [(*key, *row) for key, row in items.items()]


def indexes_of(benchmark: DataFrame, limit: int = MAX_INDEX_BYTES) -> Iterator[Index]:
    """Indexes over the benchmark, one for every ``limit`` bytes of text."""
    rows = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / limit))
    for part in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part) if parts > 1 else rows
        segments = []
        for entry, row in enumerate(own.orderBy("item_id", "text").toLocalIterator()):
            for segment in segments_of(row[0], row[1]):
                segment.entry = entry
                segments.append(segment)
        yield Index(segments)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP
) -> DataFrame:
    """One row per document and benchmark item it holds."""
    spark = prepare(docs.sparkSession)
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    rows = docs.filter("text IS NOT NULL").select("doc_id", "text")

    def ask(index: Index) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                ids, texts = list(frame["doc_id"]), list(frame["text"])
                found = [
                    (ids[lo + hit[0]], *hit[1:])
                    for lo, hi in slices([len(t) for t in texts])
                    for hit in match(shared.value, texts[lo:hi], threshold, least)
                ]
                if found:
                    out = pd.DataFrame(found, columns=names)
                    out["doc_id"] = out["doc_id"].astype("Int64")
                    yield out

        return rows.mapInPandas(run, SCHEMA)

    found = None
    for index in indexes_of(benchmark):
        one = ask(index)
        found = one if found is None else found.unionByName(one)
    return found


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP
) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, without a shuffle."""
    spark = prepare(docs.sparkSession)

    def asked(index: Index):
        shared = spark.sparkContext.broadcast(index)

        def run(text: pd.Series) -> pd.Series:
            texts = [t or "" for t in text]
            found = np.zeros(len(texts), bool)
            for lo, hi in slices([len(t) for t in texts]):
                for hit in match(shared.value, texts[lo:hi], threshold, least):
                    found[lo + hit[0]] = True
            return pd.Series(found)

        return F.pandas_udf(run, "boolean")

    for index in indexes_of(benchmark):
        docs = docs.filter(~asked(index)("text"))
    return docs
