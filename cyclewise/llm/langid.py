"""Language identification with spans.

Letters, with the marks that follow or precede them, are grouped into words. The script of a word narrows the languages that may be
meant; every word gets, per language, the sum of log probabilities of its character
trigrams. Viterbi over the words with a penalty for each change of language labels spans,
so a text of several languages is cut where it changes. The language of a document is the
one with most letters in its spans, its score the share of these letters.

Learning counts trigrams and scripts per language over all rows with a language: counts are
summed inside tasks, then by Spark; ``BUCKETS`` numbers per language come to the driver and
go out as a broadcast, a size that does not grow with the input.

Viterbi is exact. Where no stretch of words speaks for another language by more than half
the penalty, one language for all words is provably the best path, and the search is left
out; the other texts are searched in step, one word of every text at a time.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go to
the first language by name; without any learned language everything is ``und``; repeated
rows give repeated equal rows; an empty table gives an empty table. Only id and text are
read, and the language column while learning.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm.common import fold_of, prepare, slices

FOLDS = 4
HELD_OUT = 2
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Cost of a change of language, in nats.
SWITCH = 20.0
#: A script belongs to a language if it has this share of the language's words.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: No code point from here on is a letter.
LETTERS_END = 0x33480

# First code points of Unicode script blocks and their names, in order.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "latin"), (0x2C80, "coptic"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x31A0, "han"), (0xA000, "yi"), (0xA640, "cyrillic"), (0xA720, "latin"), (0xAC00, "hangul"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF21, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x32000, "other"),
]
SCRIPTS = list(dict.fromkeys(name for _, name in SCRIPT_STARTS))

LABEL_TYPE = "struct<lang:string,score:double,spans:array<struct<begin:int,end:int,lang:string>>>"


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letter of a code point (0: no letter or mark), letters, script borders and numbers."""
    lower = np.zeros(LETTERS_END + 1, np.uint32)
    letters = np.zeros(LETTERS_END + 1, bool)
    for point in range(LETTERS_END):
        c = chr(point)
        kind = unicodedata.category(c)[0]
        if kind in "LM":
            small = c.lower()
            lower[point] = ord(small) if len(small) == 1 else point
            letters[point] = kind == "L"
    starts = np.array([s for s, _ in SCRIPT_STARTS], np.uint32)
    return lower, letters, starts, np.array([SCRIPTS.index(n) for _, n in SCRIPT_STARTS], np.int16)


class Words:
    """Words of several texts: where they begin and end, their trigram buckets and scripts."""

    def __init__(self, texts: list[str]):
        lower, letters, starts, numbers = _tables()
        joined = "\0".join(texts) + "\0\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        known = np.minimum(points, LETTERS_END)
        small = lower[known]
        letter = small > 0
        edge = np.flatnonzero(np.diff(letter.astype(np.int8), prepend=np.int8(0)))
        self.begin, self.end = edge[::2], edge[1::2]  # a joined text ends with no letter
        if len(self.begin):
            word = np.logical_or.reduceat(letters[known], self.begin)  # behind a word nothing is a letter
            if not word.all():  # marks alone are no word
                small[letter] *= np.repeat(word, self.end - self.begin)
                letter = small > 0
                self.begin, self.end = self.begin[word], self.end[word]
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_at = np.concatenate([[0], np.cumsum(sizes)])
        self.first_word = np.searchsorted(self.begin, self.text_at)
        before = np.concatenate([[0], small[:-1]])
        before2 = np.concatenate([[0], before[:-1]])
        before2[before == 0] = 0
        inside = letter | (before > 0)  # the place after a word carries its last trigram
        where = np.flatnonzero(inside)
        code = small[where].astype(np.uint64) * np.uint64(0x9E3779B1)
        code += before[where].astype(np.uint64) * np.uint64(0x85EBCA6B3)
        code += before2[where].astype(np.uint64) * np.uint64(0xC2B2AE3D27)
        code ^= code >> np.uint64(15)
        code *= np.uint64(0x2545F4914F6CDD1D)
        self.bucket = (code >> np.uint64(49)).astype(np.int32)
        self.lead = np.searchsorted(where, self.begin)
        self.script = numbers[np.searchsorted(starts, points[self.begin], side="right") - 1] if len(self.begin) else np.zeros(0, np.int16)

    def scores(self, logs: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Log probability of every word in every language; ``logs`` is buckets x languages."""
        if not len(self.begin):
            return np.zeros((0, logs.shape[1]), np.float32)
        out = np.empty((len(self.begin), logs.shape[1]), np.float32)
        for k in range(logs.shape[1]):
            out[:, k] = np.add.reduceat(logs[:, k][self.bucket], self.lead)
        return out + allowed[self.script]


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for frame in frames:
        for lang, part in frame.groupby("lang", sort=False):
            texts = list(part["text"])
            total = totals.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
            for lo, hi in slices([len(t) for t in texts]):
                words = Words(texts[lo:hi])
                total[:BUCKETS] += np.bincount(words.bucket, minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(words.script, minlength=len(SCRIPTS))
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": total[at]})


class LanguageModel:
    """Trigram log probabilities and allowed scripts of the learned languages."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique())
        table = np.zeros((len(self.langs), BUCKETS + len(SCRIPTS)))
        place = {lang: i for i, lang in enumerate(self.langs)}
        table[counts["lang"].map(place).to_numpy(int), counts["bucket"].to_numpy(int)] = counts["n"].to_numpy(float)
        grams, scripts = table[:, :BUCKETS] + SMOOTHING, table[:, BUCKETS:]
        self.logs = np.ascontiguousarray(np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32).T, np.float32)
        uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
        allowed = np.where(uses, 0.0, -1e6).T
        allowed[~uses.any(0)] = 0.0  # a script nobody uses narrows nothing
        self.allowed = allowed.astype(np.float32)

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """Language, score and spans of every text."""
        words = Words(texts)
        scores = words.scores(self.logs, self.allowed)
        states = best_paths(scores, words.first_word, SWITCH)
        out = []
        sizes = words.end - words.begin
        for i in range(len(texts)):
            lo, hi = words.first_word[i], words.first_word[i + 1]
            if lo == hi:
                out.append((UNKNOWN, 0.0, []))
                continue
            own = states[lo:hi]
            letters = np.bincount(own, weights=sizes[lo:hi], minlength=len(self.langs))
            top = int(letters.argmax())
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [hi - lo]])
            base = words.text_at[i]
            spans = [
                (int(words.begin[lo + a] - base), int(words.end[lo + b - 1] - base), self.langs[own[a]])
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
            out.append((self.langs[top], float(letters[top] / letters.sum()), spans))
        return out


def best_paths(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of every word; text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""
    states = np.zeros(len(scores), np.int16)
    open_texts = []
    for lo, hi in zip(first[:-1], first[1:]):
        if lo == hi:
            continue
        part = scores[lo:hi].astype(np.float64)
        top = int(part.sum(0).argmax())
        states[lo:hi] = top
        gain = np.cumsum(part - part[:, top : top + 1], axis=0)
        low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros(gain.shape[1]), gain[:-1]]), axis=0), 0)
        if (gain - low).max() > penalty / 2:
            open_texts.append((lo, hi))
    if open_texts:
        _search(scores, open_texts, penalty, states)
    return states


def _search(scores: np.ndarray, texts: list[tuple[int, int]], penalty: float, states: np.ndarray) -> None:
    """Viterbi over the texts in step, the longest first; writes ``states``."""
    texts = sorted(texts, key=lambda t: t[0] - t[1])
    begin = np.array([lo for lo, _ in texts])
    size = np.array([hi - lo for lo, hi in texts])
    n_states = scores.shape[1]
    came = np.zeros((int(size.sum()), n_states), np.int8 if n_states < 128 else np.int16)
    row = np.concatenate([[0], np.cumsum(size)[:-1]])
    value = scores[begin].astype(np.float64)
    stay = np.arange(n_states)
    active = len(texts)
    for t in range(1, int(size[0])):
        while size[active - 1] <= t:
            active -= 1
        now = value[:active]
        top = now.argmax(1)
        change = now[np.arange(active), top][:, None] - penalty
        came[row[:active] + t] = np.where(now >= change, stay, top[:, None])
        value[:active] = np.maximum(now, change) + scores[begin[:active] + t]
    state = value.argmax(1)
    active = 0
    for t in range(int(size[0]) - 1, -1, -1):
        while active < len(texts) and size[active] > t:
            active += 1
        states[begin[:active] + t] = state[:active]
        if t:
            state[:active] = came[row[:active] + t, state[:active]]


def learn(docs: DataFrame) -> LanguageModel:
    """Learn from every row of ``text`` and non-null ``lang``."""
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = rows.mapInPandas(_count, "lang string, bucket int, n long")
    return LanguageModel(counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())


def learned_rows(docs: DataFrame) -> DataFrame:
    """Rows outside the held-out fold."""
    return docs.filter(F.coalesce(fold_of("doc_id", FOLDS) != HELD_OUT, F.lit(True)))


def labeller(spark: SparkSession, model: LanguageModel) -> Callable[[Column], Column]:
    """Column function: text to ``struct<lang, score, spans>``; the model goes out as a broadcast.

    Marked nondeterministic so that a filter on the result does not evaluate it again.
    """
    shared = spark.sparkContext.broadcast(model)

    def run(text: pd.Series) -> pd.DataFrame:
        texts = [t or "" for t in text]
        out = []
        for lo, hi in slices([len(t) for t in texts]):
            if shared.value.langs:
                out += shared.value.label(texts[lo:hi])
            else:
                out += [(UNKNOWN, 0.0, [])] * (hi - lo)
        spans = [[{"begin": b, "end": e, "lang": x} for b, e, x in o[2]] for o in out]
        return pd.DataFrame({"lang": [o[0] for o in out], "score": [o[1] for o in out], "spans": spans})

    return F.pandas_udf(run, LABEL_TYPE).asNondeterministic()


def label(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans`` of every row."""
    named = docs.select("doc_id", "text").withColumn("found", labeller(docs.sparkSession, model)("text"))
    return named.select(
        "doc_id",
        F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.spans").alias("spans"),
    )


def identify(docs: DataFrame) -> DataFrame:
    """Learn outside the held-out fold and label every document."""
    prepare(docs.sparkSession)
    return label(docs, learn(learned_rows(docs)))
