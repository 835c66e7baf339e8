"""Ordered work inside a unit, safe when one unit holds a large part of all rows.

A plain ``Window.partitionBy("unit_id")`` puts a whole unit into one task. The
functions here never do that:

* ``number_rows`` and ``previous_value`` send the rows of units above ``hot_rows``
  through ``ordered_ranges``: Spark's range partitioner samples borders on the whole
  order, so a burst, or one leading value that a unit repeats, is spread like any other
  rows. Rows are numbered inside their range; the counts of a unit's earlier ranges are
  added.
* ``unit_max`` brings the maximum of a hot unit back from a small table.
* ``open_chunks`` cuts a numbered unit into position chunks and copies the last
  ``lookback`` rows of a chunk into the next one, so a bounded frame such as a
  rolling mean is complete inside every chunk.

Units below the limit use the plain window, in the same call. ``Layout.measured`` counts
the rows per unit once; where a layout was not measured, the functions measure it. The
limit rises with the number of rows, so that at most ``MAX_HOT_UNITS`` units are hot. Side
tables have one row per hot unit, or per hot unit and range that holds rows of it (at most
hot units plus ranges), which bounds what is broadcast.

Rows that tie in the whole order are kept apart by a hash of all their columns; their
order among themselves is open. Only rows equal in every column share a range.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.constants import CYCLE, HOT_ROWS, MAX_HOT_UNITS, RANGE_MARGIN, UNIT
from cyclewise.session import settle

CHUNK = "_chunk"
HALO = "_halo"
#: Global place of a row; the partition number is in the bits from this one on.
PLACE = "_place"
RANGE = "_range"
RANGE_SHIFT = 33


@dataclass(frozen=True)
class Layout:
    """How large a unit may get before its rows are spread over several tasks."""

    hot_rows: int = HOT_ROWS
    largest: int | None = None
    #: Rows of units above the limit, as far as known.
    spread_rows: int = 0

    @classmethod
    def measured(cls, df: DataFrame, unit: str = UNIT, hot_rows: int = HOT_ROWS) -> Layout:
        """Count the rows per unit; reads the unit column only and combines before shuffling."""
        per_unit = df.groupBy(unit).agg(F.count(F.lit(1)).alias("n"))
        above = F.sum(F.when(F.col("n") > hot_rows, F.col("n")))
        largest, rows, spread = per_unit.agg(F.max("n"), F.sum("n"), above).first()
        return cls(max(hot_rows, (rows or 0) // MAX_HOT_UNITS), largest or 0, spread or 0)

    @property
    def splits(self) -> bool:
        """True unless every unit is known to fit into one task."""
        return self.largest is None or self.largest > self.hot_rows

    @property
    def ranges(self) -> int:
        """Ranges for the rows of hot units; the margin covers uneven sampled borders."""
        return max(2, math.ceil(self.spread_rows * RANGE_MARGIN / self.hot_rows))

    def known(self, df: DataFrame, unit: str = UNIT) -> Layout:
        return self if self.largest is not None else Layout.measured(df, unit, self.hot_rows)


SPLIT = Layout()


def _parted(
    df: DataFrame, unit: str, layout: Layout, *facts: Column
) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary units, and rows of hot ones with ``facts`` of their unit."""
    hot = (
        df.groupBy(F.col(unit).alias("_hot_unit"))
        .agg(F.count(F.lit(1)).alias("_rows"), *facts)
        .filter(F.col("_rows") > layout.hot_rows)
    )
    hot = F.broadcast(hot)  # at most MAX_HOT_UNITS rows
    same = F.col(unit).eqNullSafe(F.col("_hot_unit"))
    return df.join(hot, same, "left_anti"), df.join(hot, same).drop("_hot_unit")


def ordered_ranges(df: DataFrame, order: list[str], ranges: int) -> DataFrame:
    """Rows in one global order with their place: range number, then number in the range.

    The place is ``PLACE >> RANGE_SHIFT`` and the bits below. The result is settled, so all
    readers see the same borders. A hash of all columns breaks ties between borders.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    keys = [*[F.col(f"`{c}`") for c in order], F.xxhash64(*[F.col(f"`{c}`") for c in plain])]
    sorted_rows = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    return settle(sorted_rows.withColumn(PLACE, F.monotonically_increasing_id()))


def _in_ranges(df: DataFrame, unit: str, order: list[str], layout: Layout) -> DataFrame:
    rows = ordered_ranges(df, [unit, *order], layout.ranges)
    return rows.withColumn(RANGE, F.shiftright(PLACE, RANGE_SHIFT))


def _pieces(rows: DataFrame, unit: str, *facts: Column) -> DataFrame:
    """One row per hot unit and range; few, see the module's text."""
    return rows.groupBy(F.col(unit).alias("_of"), F.col(RANGE).alias("_in")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(PLACE).alias("_first"), *facts
    )


def _with_pieces(rows: DataFrame, unit: str, pieces: DataFrame) -> DataFrame:
    same = F.col(unit).eqNullSafe(F.col("_of")) & (F.col(RANGE) == F.col("_in"))
    return rows.join(F.broadcast(pieces), same)


def number_rows(
    df: DataFrame,
    order: list[str],
    unit: str = UNIT,
    position: str = CYCLE,
    remaining: str | None = None,
    layout: Layout = SPLIT,
) -> DataFrame:
    """Number the rows of each unit from 1 in ``order``, with one shuffle of the rows.

    ``remaining`` names an optional column with the rows still to come in the unit.
    """
    kept = [*df.columns, position] + ([remaining] if remaining else [])
    layout = layout.known(df, unit)

    def plain(rows: DataFrame) -> DataFrame:
        whole = Window.partitionBy(unit)
        numbered = rows.withColumn(
            position, F.row_number().over(whole.orderBy(*order)).cast("long")
        )
        if remaining is not None:
            numbered = numbered.withColumn(
                remaining, F.count(F.lit(1)).over(whole) - F.col(position)
            )
        return numbered.select(*kept)

    if not layout.splits:
        return plain(df)
    ordinary, hot = _parted(df, unit, layout)
    rows = _in_ranges(hot, unit, order, layout)
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _pieces(rows, unit).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    numbered = _with_pieces(rows, unit, offsets).withColumn(
        position, F.col(PLACE) - F.col("_first") + 1 + F.col("_before")
    )
    if remaining is not None:
        numbered = numbered.withColumn(remaining, F.col("_rows") - F.col(position))
    return plain(ordinary).unionByName(numbered.select(*kept))


def open_chunks(
    df: DataFrame, lookback: int, position: str = CYCLE, layout: Layout = SPLIT
) -> DataFrame:
    """Add the chunk of each row and copy border rows into the next chunk as halo rows.

    ``position`` has to count the rows of a unit without gaps, see ``number_rows``.
    """
    if not layout.splits:
        return df.withColumn(CHUNK, F.lit(0)).withColumn(HALO, F.lit(False))
    chunk_rows = layout.hot_rows
    if chunk_rows <= lookback:
        raise ValueError(f"chunk_rows ({chunk_rows}) must exceed lookback ({lookback})")
    zero_based = F.col(position) - 1
    home = F.floor(zero_based / F.lit(chunk_rows)).cast("long")
    at_border = F.pmod(zero_based, F.lit(chunk_rows)) >= chunk_rows - lookback
    return df.withColumn(
        CHUNK, F.explode(F.when(at_border, F.array(home, home + 1)).otherwise(F.array(home)))
    ).withColumn(HALO, F.col(CHUNK) > home)


def chunk_window(
    position: str = CYCLE, layout: Layout = SPLIT, unit: str = UNIT
) -> WindowSpec:
    keys = [unit, CHUNK] if layout.splits else [unit]
    return Window.partitionBy(*keys).orderBy(position)


def close_chunks(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(CHUNK, HALO)


def unit_max(
    df: DataFrame, value: str, out: str, unit: str = UNIT, layout: Layout = SPLIT
) -> DataFrame:
    """Attach the largest ``value`` of the unit to each of its rows.

    Ordinary units use a window, hot ones a side table of one row each; the rows of hot
    units stay where they are.
    """
    layout = layout.known(df, unit)
    plain = F.max(value).over(Window.partitionBy(unit))
    if not layout.splits:
        return df.withColumn(out, plain)
    ordinary, hot = _parted(df, unit, layout, F.max(value).alias("_max"))
    kept = [*df.columns, out]
    return (
        ordinary.withColumn(out, plain)
        .select(*kept)
        .unionByName(hot.withColumn(out, F.col("_max")).select(*kept))
    )


def previous_value(
    df: DataFrame, value: str, out: str, unit: str = UNIT, layout: Layout = SPLIT
) -> DataFrame:
    """Attach the preceding ``value`` of the unit, NULL on its first row."""
    layout = layout.known(df, unit)
    plain = F.lag(value).over(Window.partitionBy(unit).orderBy(value))
    if not layout.splits:
        return df.withColumn(out, plain)
    kept = [*df.columns, out]
    ordinary, hot = _parted(df, unit, layout)
    rows = _in_ranges(hot.select(*df.columns), unit, [value], layout)
    parts = Window.partitionBy("_of").orderBy("_in")
    carried = _pieces(rows, unit, F.max(value).alias("_top")).withColumn(
        "_carry", F.lag("_top").over(parts)
    )
    in_range = F.lag(value).over(Window.partitionBy(unit, RANGE).orderBy(PLACE))
    spread = (
        _with_pieces(rows.withColumn("_lag", in_range), unit, carried)
        .withColumn(out, F.coalesce("_lag", "_carry"))
        .select(*kept)
    )
    return ordinary.withColumn(out, plain).select(*kept).unionByName(spread)
