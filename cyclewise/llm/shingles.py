"""Word and shingle hashes of many texts at once, on arrays."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

U64 = np.uint64


@lru_cache(maxsize=1)
def _word_letters() -> np.ndarray:
    """Lower-case code point of letters, marks and digits; 0 elsewhere."""
    lower = np.zeros(0x10000, np.uint32)
    for point in range(0x10000):
        c = chr(point)
        if unicodedata.category(c)[0] in "LMN":
            small = c.lower()
            lower[point] = ord(small) if len(small) == 1 else point
    return lower


@lru_cache(maxsize=1)
def _char_powers() -> np.ndarray:
    return np.cumprod(np.full(64, 0x9E3779B97F4A7C15, U64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of letters, marks, digits; lower case), and words per text."""
    letters, charp = _word_letters(), _char_powers()
    joined = "\0".join(texts) + "\0\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.where(points < 0x10000, letters[np.minimum(points, 0xFFFF)], points)
    edge = np.flatnonzero(np.diff((small > 0).astype(np.int8), prepend=np.int8(0)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, U64), np.zeros(len(texts), np.int64)
    where = np.flatnonzero(small)
    size = end - begin
    lead = np.concatenate([[0], np.cumsum(size)[:-1]])
    inside = np.arange(len(where)) - np.repeat(lead, size)
    values = mix(small[where].astype(U64) + (inside >> 6).astype(U64) * U64(0x5851F42D4C957F2D))
    hashes = mix(np.add.reduceat(values * charp[inside & 63], lead) + size.astype(U64))
    text_at = np.concatenate([[0], np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))])
    return hashes, np.diff(np.searchsorted(begin, text_at))


def elements(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Elements of the shingle multisets of all texts, and their number per text.

    The k-th time a shingle comes in a text makes an element of its own, so a multiset is a
    set of elements, and the weight of a shingle is the number of its elements. A text with
    fewer than ``n`` words has one shingle, all of it; a text without words has none.
    """
    words, counts = word_hashes(texts)
    text = np.repeat(np.arange(len(texts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)])
    take = np.maximum(counts - n + 1, (counts > 0).astype(np.int64))
    place = np.arange(len(words)) - first[text]
    starts = np.flatnonzero(place < take[text])
    owner = text[starts]
    value = np.zeros(len(starts), U64)
    padded = np.concatenate([words, np.zeros(n, U64)])
    for k in range(n):
        inside = place[starts] + k < counts[owner]
        value = mix(value + U64(k + 1)) + np.where(inside, padded[starts + k], U64(0x2545F4914F6CDD1D))
    value = mix(value)
    key = mix(value ^ mix(owner.astype(U64) + U64(1)))
    order = np.argsort(key)
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
    if same.any():
        run = np.where(same, 0, np.arange(len(order)))
        nth = np.arange(len(order)) - np.maximum.accumulate(run)
        again = order[nth > 0]
        value[again] = mix(value[again] + nth[nth > 0].astype(U64) * U64(0xD1342543DE82EF95))
    return value, take
