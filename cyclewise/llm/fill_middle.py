"""Fill-in-middle training texts.

A text is cut at two unit boundaries into prefix, middle and suffix, which are written in
another order behind marks, so that a model learns to fill the middle from both sides. The
boundaries come from a hash of the document id: they do not depend on partitions, retries
or other documents.

Finding a boundary. The UTF-8 text is cut into blocks of ``BLOCK`` bytes. A Fenwick tree
over the blocks holds how many units and how many code points start in each. The block in
which unit ``k`` starts is found by binary lifting in the tree, which also sums the code
points before the block; inside the block alone the starts are looked up again. Memory
beyond the text is a few numbers per block, and one text is held at a time.

Units are code points (``char``), words (``word``: a unit starts at a byte that is no white
space and follows white space) or lines (``line``). A boundary after ``k`` units is where
unit ``k`` starts counting from 0, the end of the text after the last one, and 0 for none.

Texts that hold a mark stay plain, so every output can be taken apart again by its marks:
``restored`` does that in column expressions.

Defined results: a null text counts as empty; empty texts are plain; a null id hashes like
an empty one; repeated rows give equal rows; an empty table gives an empty table. Only id
and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import prepare

BLOCK = 4096
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")


@dataclass(frozen=True)
class Plan:
    """Share of texts left plain, share of the others with the suffix first, seed and marks."""

    plain_percent: int = 10
    suffix_first_percent: int = 20
    seed: int = 1
    marks: tuple[str, str, str] = MARKS
    unit: str = "char"


def _char_starts(block: np.ndarray, before: int) -> np.ndarray:
    return (block & 0xC0) != 0x80


def _word_starts(block: np.ndarray, before: int) -> np.ndarray:
    space = (block == 0x20) | ((block >= 0x09) & (block <= 0x0D))
    follows = np.empty_like(space)
    follows[0] = before < 0 or before == 0x20 or 0x09 <= before <= 0x0D
    follows[1:] = space[:-1]
    return ~space & follows


def _line_starts(block: np.ndarray, before: int) -> np.ndarray:
    starts = np.empty(len(block), bool)
    starts[0] = before < 0 or before == 0x0A
    starts[1:] = block[:-1] == 0x0A
    return starts


#: Bytes of a block and the byte before it (-1 at the text's begin) to the bytes that start a unit.
UNITS: dict[str, Callable[[np.ndarray, int], np.ndarray]] = {
    "char": _char_starts,
    "word": _word_starts,
    "line": _line_starts,
}


class BlockTree:
    """Fenwick tree over the blocks of a text with unit and code-point counts."""

    def __init__(self, data: bytes, unit: str = "char", block: int = BLOCK):
        self.bytes = np.frombuffer(data, np.uint8)
        self.starts_of = UNITS[unit]
        self.block = block
        n_blocks = -(-len(data) // block)
        self.tree = [[0, 0] for _ in range(n_blocks + 1)]
        for i in range(n_blocks):
            self.tree[i + 1][0] += int(np.count_nonzero(self._unit_starts(i)))
            self.tree[i + 1][1] += int(np.count_nonzero(_char_starts(self._slice(i), -1)))
            parent = (i + 1) + ((i + 1) & -(i + 1))
            if parent <= n_blocks:
                self.tree[parent][0] += self.tree[i + 1][0]
                self.tree[parent][1] += self.tree[i + 1][1]
        self.units, self.chars = self._before(n_blocks)

    def _slice(self, i: int) -> np.ndarray:
        return self.bytes[i * self.block : (i + 1) * self.block]

    def _unit_starts(self, i: int) -> np.ndarray:
        return self.starts_of(self._slice(i), int(self.bytes[i * self.block - 1]) if i else -1)

    def _before(self, blocks: int) -> tuple[int, int]:
        """Units and code points in the first ``blocks`` blocks."""
        units = chars = 0
        while blocks:
            units += self.tree[blocks][0]
            chars += self.tree[blocks][1]
            blocks &= blocks - 1
        return units, chars

    def boundary(self, k: int) -> tuple[int, int]:
        """Byte and code point at which the first ``k`` units end."""
        if k <= 0:
            return 0, 0
        if k >= self.units:
            return len(self.bytes), self.chars
        at, left, chars = 0, k, 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            after = at + step
            if after < len(self.tree) and self.tree[after][0] <= left:
                at = after
                left -= self.tree[after][0]
                chars += self.tree[after][1]
            step >>= 1
        local = int(np.flatnonzero(self._unit_starts(at))[left])
        return at * self.block + local, chars + int(np.count_nonzero(_char_starts(self._slice(at)[:local], -1)))


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers below 2**32 from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def cut(doc_id, data: bytes, plan: Plan) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle, and the text in its new order."""
    tree = BlockTree(data, plan.unit)
    h1, h2, h3, h4 = draws(doc_id, plan.seed)
    prefix_mark, suffix_mark, middle_mark = marks = [m.encode() for m in plan.marks]
    if not data or any(m in data for m in marks) or h3 % 100 >= 100 - plan.plain_percent:
        return tree.units, "plain", None, None, data
    low, high = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
    (begin, n_prefix), (end, n_upto) = tree.boundary(low), tree.boundary(high)
    prefix, middle, suffix = data[:begin], data[begin:end], data[end:]
    if h4 % 100 < plan.suffix_first_percent:
        form, parts = "spm", (suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle)
    else:
        form, parts = "psm", (prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle)
    return tree.units, form, n_prefix, n_upto - n_prefix, b"".join(parts)


def _rows(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        found = [cut(i, t.as_py() or b"", plan) for i, t in zip(batch.column("doc_id").to_pylist(), texts)]
        n, form, prefix, middle, output = zip(*found) if found else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def transform(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every text."""
    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _rows(batches, plan), schema)


def _cut_at(text: Column, mark: str) -> tuple[Column, Column]:
    """What stands before and behind the first mark."""
    head = F.substring_index(text, mark, 1)
    return head, F.substr(text, F.length(head) + F.lit(len(mark) + 1))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The original text, taken apart at the marks of its output."""
    prefix_mark, suffix_mark, middle_mark = marks
    rest = F.substr(output, F.lit(len(prefix_mark) + 1))
    prefix, rest = _cut_at(rest, suffix_mark)
    suffix, middle = _cut_at(rest, middle_mark)
    psm = F.concat(prefix, middle, suffix)
    rest = F.substr(output, F.lit(len(suffix_mark) + 1))
    suffix, rest = _cut_at(rest, prefix_mark)
    prefix, middle = _cut_at(rest, middle_mark)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(cuts: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """The output and the text restored from it as digests."""
    back = restored(F.col("output"), F.col("form"), marks)
    return cuts.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def fill_middle_sql() -> str:
    """The rows of ``digests`` for units of one code point and the production plan."""
    p, s, m = MARKS
    plan = Plan()

    def number(i: int) -> str:
        return f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS UBIGINT)"

    return f"""
    WITH hashed AS (
      SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
             sha256('{plan.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    drawn AS (
      SELECT doc_id, t, n, CAST({number(0)} % (n + 1) AS BIGINT) AS a, CAST({number(1)} % (n + 1) AS BIGINT) AS b,
        CASE WHEN n = 0 OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}')
                  OR {number(2)} % 100 >= {100 - plan.plain_percent} THEN 'plain'
             WHEN {number(3)} % 100 < {plan.suffix_first_percent} THEN 'spm' ELSE 'psm' END AS form
      FROM hashed),
    cut AS (
      SELECT *, least(a, b) AS p, greatest(a, b) - least(a, b) AS m, substr(t, 1, least(a, b)) AS prefix,
             substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
             substr(t, greatest(a, b) + 1) AS suffix FROM drawn)
    SELECT doc_id, n, form,
      CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN m END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t
             WHEN 'psm' THEN '{p}' || prefix || '{s}' || suffix || '{m}' || middle
             ELSE '{s}' || suffix || '{p}' || prefix || '{m}' || middle END) AS output_sha256,
      sha256(t) AS restored_sha256
    FROM cut"""
