"""Personal data in texts: fixed patterns, and a linear-chain conditional random field.

Patterns find the standard writings of emails, IPv4 addresses, card numbers and phone
numbers (``base_spans``). The random field adds writings that no pattern lists: phone
numbers without a plus, card numbers with other separators, defanged or IPv6 addresses,
spelled-out emails.

The field labels the words of short windows with O, B-kind and I-kind. Its features are word
shapes (digits, letters, signs), digit groups, their neighbours' shapes and cue words. It
is fitted by penalised likelihood (forward-backward over all rows at once) on a small
labelled table, at most ``MAX_LABELLED`` rows: ``labelled_rows`` builds one by rule, any
table of ``text, spans`` can take its place. Decoding is Viterbi over all windows of an
Arrow batch, in numpy, windows of similar length together.

Windows. Only words that can be part of an added span may get another label than O: words
of a group of digits, of an IPv6 address, or around a spelled-out at-sign. Words beside them
are seen as context with the label O, which cuts the chain, so each window is decoded by
itself, however long the text. Windows in which no span could pass its kind's check are
skipped. A span of the field is kept if it passes the check (digits, check sum, octets,
address syntax) and touches no pattern's span; the patterns' spans always stay.

Every pattern search is linear in the text, also for hostile ones: an email is searched from
its at-sign, runs of digits or signs are entered at their begin only.

Defined results: a null or empty text has no spans; null ids are kept; repeated rows give
equal rows; an empty table gives an empty table. Only id and text are read.
"""

from __future__ import annotations

import ipaddress
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import prepare

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
K = len(LABELS)
#: Labelled rows that are fitted at most; further rows by hash of the text are left out.
MAX_LABELLED = 2_000
STEPS = 150
RATE = 0.1
PENALTY = 0.05
#: Words beside a window that its features see.
CONTEXT = 2
SPAN_TYPE = "array<struct<kind:string,start:long,end:long,method:string>>"
NEVER = -1e9

# Patterns


_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _small(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) < 4 and int(number or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        else:
            done = at + 1  # no start left of this sign can match
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by kind, then begin."""
    spans = [("email", b, e) for b, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(_small(part) for part in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


# Windows and words

_WORD = re.compile(r"[^\s\"'<>,;!?#$%&*|=^~`\\{}]+")
_GROUP = re.compile(r"[0-9](?:[ \xa0.\-()/\[\]–]{0,3}[0-9])++")
_SIX = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]*+(?![0-9A-Za-z])")
_AT = re.compile(r"[\[(]\s?at\s?[\])]|(?<!\S)at\s{1,4}\S{1,63}\s{1,4}(?:dot(?!\S)|[\[(]\s?dot)|(?<=\S)\s@\s(?=\S)", re.I)
_AT_HINT = ("dot", "DOT", "Dot", "(at", "[at", "(AT", "[AT", "( at", "[ at", " @ ")
#: Words before and behind a spelled-out at-sign that may belong to its email.
BEFORE_AT, BEHIND_AT = 2, 8
LEAST_DIGITS = 9


@dataclass
class Window:
    """Words of a window with their places; ``free`` words may get a label."""

    words: list[str]
    begins: list[int]
    free: list[bool]


def _window(text: str, lo: int, hi: int, more: tuple[int, int] = (0, 0)) -> Window:
    """Words that touch ``[lo, hi)`` and, free as well, ``more`` words on both sides, then context."""
    left, right = more[0] + CONTEXT, more[1] + CONTEXT
    reach = 24 * (left + 1)
    around = list(_WORD.finditer(text, max(0, lo - reach), min(len(text), hi + 24 * (right + 1))))
    inside = [i for i, m in enumerate(around) if m.end() > lo and m.start() < hi]
    if not inside:
        return Window([], [], [])
    first, last = max(0, inside[0] - left), min(len(around) - 1, inside[-1] + right)
    free = range(inside[0] - more[0], inside[-1] + more[1] + 1)
    return Window(
        [around[i][0] for i in range(first, last + 1)],
        [around[i].start() for i in range(first, last + 1)],
        [i in free for i in range(first, last + 1)],
    )


def _octets(text: str) -> bool:
    parts = re.findall(r"[0-9]+", text)
    return len(parts) == 4 and all(_small(p) for p in parts)


def _six(text: str) -> bool:
    groups = [g for g in text.split(":") if g]
    if len(groups) < 3 or not any(c.isdigit() for c in text):
        return False
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def windows(text: str, base: list[tuple[str, int, int]]) -> list[Window]:
    """Windows in which an added span could pass its check, apart from each other."""
    covered = sorted((b, e) for _, b, e in base)

    def known(lo: int, hi: int) -> bool:
        return any(b <= lo and hi <= e for b, e in covered)

    found = []
    for m in _GROUP.finditer(text):
        n = len(digits_of(m[0]))
        if (n >= LEAST_DIGITS or n >= 4 and ("[.]" in m[0] or "(.)" in m[0])) and not known(*m.span()):
            found.append((*m.span(), (0, 0)))
    if "::" in text or text.count(":") >= 7:
        found += [(*m.span(), (0, 0)) for m in _SIX.finditer(text) if _six(m[0])]
    if any(hint in text for hint in _AT_HINT):
        found += [(*m.span(), (BEFORE_AT, BEHIND_AT)) for m in _AT.finditer(text)]
    return [w for w in (_window(text, lo, hi, more) for lo, hi, more in sorted(found)) if w.words]


# Features

_RUN = re.compile(r"(.)\1+")
_HEX = re.compile(r"[0-9A-Fa-f]+")
_HEX_WORD = re.compile(r"[0-9A-Fa-f:]*:[0-9A-Fa-f:]*\.?")


def shape(word: str) -> str:
    kinds = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word[:40])
    return kinds[:24]


def _short(word: str, shaped: str) -> str:
    """Shape with runs of one sign as a single one; hexadecimal groups between colons look alike."""
    return _HEX.sub("h", word) if len(word) <= 40 and _HEX_WORD.fullmatch(word) else _RUN.sub(r"\1", shaped)


def _digit_groups(word: str) -> str:
    return "-".join(str(min(len(g), 9)) for g in re.findall(r"[0-9]+", word)[:6])


def features(words: list[str]) -> list[list[str]]:
    shapes = [shape(w) for w in words]
    short = [_short(w, s) for w, s in zip(words, shapes)]
    groups = [_digit_groups(w) for w in words]
    lower = [w.lower().strip(".:()[]") if w and not digits_of(w) else "" for w in words]

    def at(values: list[str], i: int) -> str:
        return values[i] if 0 <= i < len(values) else "^" if i < 0 else "$"

    rows = []
    for i, word in enumerate(words):
        digits = digits_of(word)
        row = [
            "bias", f"s={shapes[i]}", f"c={short[i]}", f"g={groups[i]}", f"n={min(len(digits), 20)}",
            f"l={lower[i]}" if len(lower[i]) <= 3 else "l=word",
            f"g3={at(groups, i - 1)}|{groups[i]}|{at(groups, i + 1)}",
            f"g5={at(groups, i - 2)}|{at(groups, i - 1)}|{groups[i]}|{at(groups, i + 1)}|{at(groups, i + 2)}",
            f"c-={at(short, i - 1)}", f"c+={at(short, i + 1)}",
            f"w-={at(lower, i - 1)}", f"w--={at(lower, i - 2)}", f"w+={at(lower, i + 1)[:3]}",
        ]
        if 13 <= len(digits) <= 19 and luhn(digits):
            row.append("luhn")
        if _octets(word):
            row.append("octets")
        if ":" in word and _six(word.strip("[]()")):
            row.append("six")
        if any(c in word for c in "@") or "at" in lower[i][:4]:
            row.append("at")
        rows.append(row)
    return rows


def transitions_allowed() -> np.ndarray:
    """An I label follows the B or I label of its kind only; the last row is the begin."""
    allowed = np.zeros((K + 1, K))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            allowed[:, j] = NEVER
            allowed[[j, j - 1], j] = 0.0
    return allowed


@dataclass
class Field:
    """Weights of the features and transitions; row 0 belongs to unknown features and stays 0."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def rows(self, words: list[str]) -> np.ndarray:
        """Scores of the labels at every word."""
        found = [[self.index.get(f, 0) for f in row] for row in features(words)]
        width = max(map(len, found))
        padded = np.array([row + [0] * (width - len(row)) for row in found])
        return self.weights[padded].sum(axis=1)


def _padded(tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in tables])
    scores = np.zeros((len(tables), lengths.max(), K))
    for i, t in enumerate(tables):
        scores[i, : len(t)] = t
    return scores, lengths


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> list[np.ndarray]:
    """Best labels of several sequences at once; ``scores`` is sequences x steps x labels."""
    n, steps, _ = scores.shape
    best = scores[:, 0] + moves[K]
    back = np.zeros((n, steps, K), np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + moves[None, :K, :]
        back[:, t] = through.argmax(axis=1)
        stepped = through.max(axis=1) + scores[:, t]
        best = np.where((t < lengths)[:, None], stepped, best)
    out = []
    for i in range(n):
        label = int(best[i].argmax())
        path = [label]
        for t in range(int(lengths[i]) - 1, 0, -1):
            label = int(back[i, t, label])
            path.append(label)
        out.append(np.array(path[::-1]))
    return out


def decode(model: Field, found: list[Window]) -> list[np.ndarray]:
    """Labels of the words of every window; windows of similar length go together."""
    tables = []
    for w in found:
        scores = model.rows(w.words)
        scores[~np.array(w.free), 1:] += NEVER
        tables.append(scores)
    out: list[np.ndarray] = [np.empty(0)] * len(found)
    order = sorted(range(len(found)), key=lambda i: len(tables[i]))
    at = 0
    while at < len(order):
        size, end = len(tables[order[at]]), at + 1
        while end < len(order) and len(tables[order[end]]) <= size + 4 and (end - at) * size < 200_000:
            end += 1
        for i, path in zip(order[at:end], viterbi(*_padded([tables[i] for i in order[at:end]]), model.moves)):
            out[i] = path
        at = end
    return out


# Fitting


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log partition, label marginals and summed transition marginals (begin row last) of padded sequences.

    Forward-backward on probabilities that are scaled to sum 1 at every step.
    """
    n, steps, _ = scores.shape
    top = scores.max(axis=2, keepdims=True)
    local, step, first = np.exp(scores - top), np.exp(moves[:K]), np.exp(moves[K])
    live = np.arange(steps)[None] < lengths[:, None]
    forward, scale = np.zeros((n, steps, K)), np.ones((n, steps))
    for t in range(steps):
        here = local[:, t] * (first if t == 0 else forward[:, t - 1] @ step)
        scale[:, t] = np.where(live[:, t], here.sum(axis=1), 1.0)
        forward[:, t] = np.where(live[:, t, None], here / scale[:, t, None], forward[:, t - 1] if t else 0.0)
    total = (np.log(scale) + np.where(live, top[:, :, 0], 0.0)).sum(axis=1)
    backward, pairs = np.ones((n, steps, K)), np.zeros((K + 1, K))
    for t in range(steps - 2, -1, -1):
        ahead = np.where(live[:, t + 1, None], local[:, t + 1] * backward[:, t + 1] / scale[:, t + 1, None], 0.0)
        pairs[:K] += step * (forward[:, t].T @ ahead)
        backward[:, t] = np.where(live[:, t + 1, None], ahead @ step.T, 1.0)
    single = np.where(live[:, :, None], forward * backward, 0.0)
    pairs[K] = single[:, 0].sum(axis=0)
    return total, single, pairs


def _labels(words: list[str], begins: list[int], spans: Iterable[tuple[str, int, int]]) -> list[int]:
    """Labels of words: the first word that a span touches begins it."""
    out = [0] * len(words)
    for kind, lo, hi in spans:
        inside = [i for i, (w, b) in enumerate(zip(words, begins)) if b < hi and b + len(w) > lo]
        for i in inside:
            out[i] = LABELS.index(f"{'B' if i == inside[0] else 'I'}-{kind}")
    return out


def fit(rows: list[tuple[str, list[tuple[str, int, int]]]], steps: int = STEPS) -> Field:
    """Fit on ``(text, spans)``; all rows at once, steps along the gradient with momentum, scaled per weight."""
    allowed = transitions_allowed()
    if not rows:
        return Field({}, np.zeros((1, K)), allowed)
    parsed = [(m := list(_WORD.finditer(text)), [x[0] for x in m], [x.start() for x in m], spans) for text, spans in rows]
    parsed = [p for p in parsed if p[1]]
    index: dict[str, int] = {}
    tokens, truth, lengths = [], [], []
    for _, words, begins, spans in parsed:
        for row in features(words):
            tokens.append([index.setdefault(f, len(index) + 1) for f in row])
        truth += _labels(words, begins, spans)
        lengths.append(len(words))
    sizes, width = np.array(lengths), max(map(len, tokens))
    ids = np.array([row + [0] * (width - len(row)) for row in tokens])
    where = np.array([(i, t) for i, n in enumerate(lengths) for t in range(n)])
    gold = np.zeros((len(truth), K))
    gold[np.arange(len(truth)), truth] = 1.0
    moved = np.zeros((K + 1, K))
    for (_, t), before, label in zip(where, [0, *truth], truth):
        moved[K if t == 0 else before, label] += 1
    weights, free = np.zeros((len(index) + 1, K)), np.zeros((K + 1, K))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, free)]
    by_feature = np.argsort(ids, axis=None, kind="stable")  # words of a feature lie together
    present, firsts = np.unique(ids.ravel()[by_feature], return_index=True)
    word_of = by_feature // width
    for step in range(1, steps + 1):
        scores = np.zeros((len(parsed), sizes.max(), K))
        scores[where[:, 0], where[:, 1]] = weights[ids].sum(axis=1)
        _, single, pairs = marginals(scores, sizes, free + allowed)
        off = gold - single[where[:, 0], where[:, 1]]
        rise = np.zeros_like(weights)
        rise[present] = np.add.reduceat(off[word_of], firsts, axis=0)
        rise[0] = 0.0
        for x, g, (mean, square) in (
            (weights, rise - PENALTY * weights, moments[0]), (free, moved - pairs - PENALTY * free, moments[1])
        ):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            x += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(index, weights, free + allowed)


def learn(labelled: DataFrame) -> Field:
    """Fit on a small table ``text, spans`` (kind, start, end), at most ``MAX_LABELLED`` rows of it."""
    rows = labelled.select("text", "spans").filter("text IS NOT NULL")
    few = rows.orderBy(F.xxhash64("text"), "text").limit(MAX_LABELLED).collect()
    return fit([(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"] or []]) for r in few])


# The labelled table

_CUES = {
    "phone": ["phone", "tel", "call", "mobile", "fax:", "Tel.", "Phone:", "ring", "number"],
    "card": ["card", "visa", "Card:", "pay", "credit", "charged"],
    "ip": ["ip", "host", "server", "IP:", "ping", "address"],
    "email": ["mail", "email", "write", "contact", "E-mail:", "reach"],
}
_SYLLABLES = "an be co de er fi go ha in jo ka le mo ne or pa re si to un ver wa xi ya zu ch st th".split()


def _plain(rng: random.Random) -> str:
    word = "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))
    return word.capitalize() if rng.random() < 0.15 else word


def _number(rng: random.Random, n: int) -> str:
    return str(rng.randint(10 ** (n - 1), 10**n - 1))


def _card_number(rng: random.Random, n: int) -> str:
    body = _number(rng, n - 1)
    return next(body + c for c in "0123456789" if luhn(body + c))


def _positives(rng: random.Random) -> list[tuple[str, str]]:
    a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
    card = _card_number(rng, 16)
    fours = [card[i : i + 4] for i in range(0, 16, 4)]
    short = _card_number(rng, 15)
    octets = [str(rng.randint(1, 255)) for _ in range(4)]
    six = [f"{rng.randint(16, 65535):x}" for _ in range(8)]
    user, host, top = _plain(rng).lower(), _plain(rng).lower() + _number(rng, 1), rng.choice(["com", "org", "net", "de"])
    return [
        ("phone", f"({a}) {b}-{c}"), ("phone", f"{a}-{b}-{c}"), ("phone", f"{a}.{b}.{c}"), ("phone", f"{a} {b} {c}"),
        ("phone", f"1-{a}-{b}-{c}"), ("phone", f"1 ({a}) {b}-{c}"), ("phone", f"({a}){b}-{c}"),
        ("phone", f"00{_number(rng, 2)} {a} {_number(rng, 7)}"), ("phone", f"0{_number(rng, 2)} {_number(rng, 7)}"),
        ("phone", f"0{_number(rng, 3)}/{_number(rng, 6)}"), ("phone", f"00 {_number(rng, 2)} {a} {b} {c}"),
        ("card", ".".join(fours)), ("card", "/".join(fours)), ("card", "  ".join(fours)), ("card", "–".join(fours)),
        ("card", f"{short[:4]}.{short[4:10]}.{short[10:]}"),
        ("ip", "[.]".join(octets)), ("ip", "(.)".join(octets)), ("ip", ":".join(six)),
        ("ip", f"{six[0]}:{six[1]}::{six[2]}:{six[3]}"), ("ip", f"fe80::{six[4]}:{six[5]}"),
        ("email", f"{user} [at] {host} [dot] {top}"), ("email", f"{user}.{host} (at) {host} (dot) {top}"),
        ("email", f"{user} at {host} dot {top}"), ("email", f"{user}(at){host}.{top}"), ("email", f"{user} @ {host}.{top}"),
        ("email", f"{user}[at]{host}[dot]{top}"), ("email", f"{user} at {host} dot {_plain(rng).lower()} dot {top}"),
    ]


def _negatives(rng: random.Random) -> list[str]:
    year = rng.randint(1900, 2030)
    day, month, hour, minute = rng.randint(10, 28), rng.randint(10, 12), rng.randint(10, 23), rng.randint(10, 59)
    tens = [str(rng.randint(10, 99)) for _ in range(6)]
    word = _plain(rng).lower()
    return [
        f"{year}-{month}-{day} {hour}:{minute}:{rng.randint(10, 59)}", f"{day}.{month}.{year} {hour}.{minute}",
        f"{day}/{month}/{year} {day}/{month}/{year + 1}", f"{year}-{year + 5} {year + 7}-{year + 9}",
        f"{_number(rng, 3)} {_number(rng, 3)} {_number(rng, 3)} {_number(rng, 3)}",
        f"{rng.randint(1, 9)}.{_number(rng, 12)}", f"{_number(rng, 10)}", f"{_number(rng, 16)}", f"{_number(rng, 9)}",
        " ".join(tens), "-".join(tens), f"{_number(rng, 4)} {_number(rng, 4)} {_number(rng, 4)}",
        f"978-{_number(rng, 1)}-{_number(rng, 2)}-{_number(rng, 6)}-{_number(rng, 1)}",
        f"{_number(rng, 5)}.{_number(rng, 5)}", f"{_number(rng, 2)}.{_number(rng, 6)} {_number(rng, 1)}.{_number(rng, 6)}",
        f"{_number(rng, 1)} {_number(rng, 3)} {_number(rng, 3)}.{_number(rng, 2)}", f"{_number(rng, 6)}-{_number(rng, 6)}",
        f"{rng.randint(1, 9)}-{rng.randint(1, 9)} {rng.randint(1, 9)}-{rng.randint(1, 9)} {_number(rng, 5)}",
        f"{word} at {_plain(rng)} dot {_plain(rng)}s", f"look at the dot on {word}", f"{word} (at) {_plain(rng)} {word}",
        f"{word} @ {_plain(rng)} {word}", f"{_number(rng, 8)}/{_number(rng, 4)}", f"{_number(rng, 2)}:{_number(rng, 2)}:{_number(rng, 2)}",
    ]


def labelled_rows(rounds: int = 14, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A small labelled table by rule: every writing ``rounds`` times among plain words, half with a cue word."""
    rng = random.Random(seed)
    rows = []

    def around(inner: str, kind: str | None) -> None:
        left = [_plain(rng) for _ in range(rng.randint(0, 3))]
        if kind and rng.random() < 0.5:
            left.append(rng.choice(_CUES[kind]))
        right = [_plain(rng) for _ in range(rng.randint(0, 3))]
        lead = "".join(w + " " for w in left)
        tail = "".join(" " + w for w in right) + rng.choice(["", "", "."])
        rows.append((lead + inner + tail, [(kind, len(lead), len(lead) + len(inner))] if kind else []))

    for _ in range(rounds):
        for kind, writing in _positives(rng):
            around(writing, kind)
        for writing in _negatives(rng):
            around(writing, None)
    return rows


# Spans of the field

_EDGE = {"phone": "0123456789", "card": "0123456789"}


def _trimmed(text: str, kind: str, lo: int, hi: int) -> tuple[int, int]:
    """A span without the signs that only end a sentence or open a bracket that nothing closes."""
    while hi > lo and (text[hi - 1] in ".:/-[(" or kind in _EDGE and text[hi - 1] not in _EDGE[kind]):
        hi -= 1
    while lo < hi and (text[lo] in ".:/-])" or text[lo] in "([" and text.find(")" if text[lo] == "(" else "]", lo, hi) < 0):
        lo += 1
    while hi > lo and (
        text[hi - 1] == ")" and "(" not in text[lo:hi] or text[hi - 1] == "]" and "[" not in text[lo:hi]
    ):
        hi -= 1
    return lo, hi


_SPELLED_AT = re.compile(r"\s*(?:[\[(]\s?at\s?[\])]|(?<=\s)at(?=\s)|@)\s*", re.I)
_SPELLED_DOT = re.compile(r"\s*(?:[\[(]\s?dot\s?[\])]|(?<=\s)dot(?=\s)|\.)\s*", re.I)
_WHOLE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}")


def passes(kind: str, text: str) -> bool:
    """Whether a span of the field is a possible value of its kind."""
    if kind == "email":
        return _WHOLE_EMAIL.fullmatch(_SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", text))) is not None
    if kind == "ip":
        return _six(text) or bool(re.fullmatch(r"[0-9]+(?:[\[(]?\.[\])]?[0-9]+){3}", text)) and _octets(text)
    digits = digits_of(text)
    if not re.fullmatch(r"[0-9 \xa0.\-()/–]+", text):
        return False
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return LEAST_DIGITS <= len(digits) <= 15 and len(digits) < len(text)


def _added(text: str, w: Window, path: np.ndarray, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    i = 0
    while i < len(path):
        label = LABELS[path[i]]
        if label == "O":
            i += 1
            continue
        end = i + 1
        while end < len(path) and LABELS[path[end]] == "I" + label[1:]:
            end += 1
        kind = label[2:]
        lo, hi = _trimmed(text, kind, w.begins[i], w.begins[end - 1] + len(w.words[end - 1]))
        if passes(kind, text[lo:hi]) and all(hi <= b or e <= lo for b, e in taken):
            yield kind, lo, hi
        i = end


def find_all(texts: list[str], model: Field) -> list[list[tuple[str, int, int, str]]]:
    """``(kind, start, end, method)`` of every text, by kind as listed, then start."""
    bases = [base_spans(t) for t in texts]
    placed = [(i, w) for i, (t, b) in enumerate(zip(texts, bases)) for w in windows(t, b)]
    paths = decode(model, [w for _, w in placed])
    found = [[(*s, "pattern") for s in base] for base in bases]
    taken = [[(b, e) for _, b, e in base] for base in bases]
    for (i, w), path in zip(placed, paths):
        for span in _added(texts[i], w, path, taken[i]):
            found[i].append((*span, "field"))
            taken[i].append(span[1:])
    return [sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])) for spans in found]


def masked(text: str, spans: list[tuple[str, int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans count as one."""
    parts, done = [], 0
    for kind, lo, hi, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if lo >= done:
            parts += [text[done:lo], f"[{kind}]"]
        done = max(done, hi)
    return "".join([*parts, text[done:]])


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("method", pa.string())])
)
_NAMES = ("kind", "start", "end", "method")


def _rows(batches: Iterator[pa.RecordBatch], model: Field, mask: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        found = find_all(texts, model)
        spans = pa.array([[dict(zip(_NAMES, s)) for s in of_text] for of_text in found], _SPANS)
        columns = {"doc_id": batch.column("doc_id"), "spans": spans}
        if mask:
            columns["masked"] = pa.array([masked(t, s) for t, s in zip(texts, found)], pa.string())
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def find(docs: DataFrame, model: Field | None = None, mask: bool = False) -> DataFrame:
    """``doc_id, spans`` of every text, on request with the ``masked`` text.

    Without a model, one is fitted on ``labelled_rows``.
    """
    prepare(docs.sparkSession)
    model = model or fit(labelled_rows())
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, spans {SPAN_TYPE}" + (", masked string" if mask else "")
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _rows(batches, model, mask), schema)


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the patterns' spans, and all spans as one string."""
    base = F.filter("spans", lambda s: s["method"] == "pattern")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
