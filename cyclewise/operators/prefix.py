"""Ordered running totals over values that do not fit into one task.

Values are aggregated first, so one value held by many rows is one entry. Spark's range
partitioner samples borders from these entries and deals them out in order; each range
is summed on its own and shifted by the total of the ranges before it. The ranged entries
are settled once: all later steps read them, never the rows again, and agree on the
borders. Only the table of range totals, at most one row per range and two per group, is
ever ordered as a whole. Without a given number there are as many ranges as shuffle
partitions, so the work spreads over a cluster of any size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.session import settle

BUCKET = "_bucket"


def range_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_ranges(counts: DataFrame, order: list[str], buckets: int | None = None) -> DataFrame:
    """Entries dealt out by sampled borders of ``order``, settled, with their range as ``BUCKET``."""
    dealt = counts.repartitionByRange(buckets or range_count(counts), *order)
    return settle(dealt.withColumn(BUCKET, F.spark_partition_id()))


def running_totals(
    counts: DataFrame,
    value: str,
    amounts: list[str],
    group: list[str] | None = None,
    following: str | None = None,
) -> DataFrame:
    """Add ``{a}_upto`` (inclusive) and ``{a}_total`` per group for every amount.

    ``counts`` has one row per group and value, with its range. ``following`` names a column
    for the next value of the group; behind the last value of a range that is the first one
    of the next range that has values.
    """
    group = group or []
    key = [*group, BUCKET]
    totals = counts.groupBy(*key).agg(
        *[F.sum(a).alias(a) for a in amounts], F.min(value).alias("_first")
    )
    whole = Window.partitionBy(*group)
    before = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *key,
        *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_{a}_before") for a in amounts],
        *[F.sum(a).over(whole).alias(f"{a}_total") for a in amounts],
        F.lead("_first").over(whole.orderBy(BUCKET)).alias("_next_range"),
    )
    ordered = Window.partitionBy(*key).orderBy(value)
    inside = ordered.rowsBetween(Window.unboundedPreceding, 0)
    upcoming = F.coalesce(F.lead(value).over(ordered), F.col("_next_range"))
    return counts.join(F.broadcast(offsets), key).select(
        *counts.columns,
        *[(F.col(f"_{a}_before") + F.sum(a).over(inside)).alias(f"{a}_upto") for a in amounts],
        *[f"{a}_total" for a in amounts],
        *([upcoming.alias(following)] if following else []),
    )


def value_counts(
    df: DataFrame,
    value: str,
    amounts: dict[str, Column],
    buckets: int | None = None,
    group: list[str] | None = None,
) -> DataFrame:
    """One row per group and distinct value with its amounts and range, settled.

    Missing values are left out. The only pass over ``df``.
    """
    group = group or []
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(*[c.cast("long").alias(n) for n, c in amounts.items()])
    )
    return in_ranges(counted, [*group, value], buckets)


def exact_quantiles(
    df: DataFrame, value: str, probabilities: list[float], buckets: int | None = None
) -> list[float]:
    """Quantiles with linear interpolation, without ordering all values anywhere.

    The bucket totals tell which buckets hold the wanted ranks; only those buckets
    are ordered.
    """
    known = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(value)
    counts = value_counts(known, value, {"n": F.count(F.lit(1))}, buckets)
    totals = sorted(
        (r[BUCKET], r["n"]) for r in counts.groupBy(BUCKET).agg(F.sum("n").alias("n")).collect()
    )
    rows = sum(n for _, n in totals)
    if rows == 0:
        raise ValueError(f"no values in {value}")
    ranks = {p: p * (rows - 1) for p in probabilities}
    wanted = sorted({math.floor(r) for r in ranks.values()} | {math.ceil(r) for r in ranks.values()})
    starts, seen = {}, 0
    for bucket, n in totals:
        starts[bucket] = (seen, seen + n)
        seen += n
    needed = [b for b, (lo, hi) in starts.items() if any(lo <= w < hi for w in wanted)]
    inside = Window.partitionBy(BUCKET).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    start = F.coalesce(*[F.when(F.col(BUCKET) == b, F.lit(starts[b][0])) for b in needed])
    placed = counts.filter(F.col(BUCKET).isin(needed)).withColumn(
        "_end", start + F.sum("n").over(inside)
    )
    holds = [(F.col("_end") > w) & (F.col("_end") - F.col("n") <= w) for w in wanted]
    hit = holds[0]
    for condition in holds[1:]:
        hit = hit | condition
    found = placed.filter(hit).select(value, "_end", "n").collect()
    at = {w: r[value] for r in found for w in wanted if r["_end"] - r["n"] <= w < r["_end"]}
    return [
        at[math.floor(r)] + (at[math.ceil(r)] - at[math.floor(r)]) * (r - math.floor(r))
        for r in (ranks[p] for p in probabilities)
    ]
