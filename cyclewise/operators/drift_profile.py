"""Drift of many batches against one reference that is counted once.

``save_profile`` keeps the cumulative counts of the reference: every distinct value of a
feature with the rows at it and up to it, in ranges of similar size, one folder a range.
A table of borders has the first and last value of each range and the rows before it.

A batch is compared with ``test_against``. It is counted once; its values meet only the
ranges that hold some of them (other folders are not opened). A range without any is one
entry, its last value with all its rows: the batch's distribution is flat over it, so the
largest distance there is at its ends, and the statistic stays exact. The merged entries
are dealt by sampled borders and summed as in any other test. The cost of a batch follows
its own values and the ranges they touch, never the rows of the reference.

Borders are at most ranges plus features, and are the only thing the driver reads.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.constants import DRIFT_P_VALUE, DRIFT_SHARE
from cyclewise.operators import drift
from cyclewise.operators.prefix import BUCKET, in_ranges, running_totals, value_counts
from cyclewise.session import settle

PART = "part"


def save_profile(
    reference: DataFrame, columns: list[str], path: str, ranges: int | None = None
) -> None:
    """Count the reference once and keep its cumulative counts and borders under ``path``."""
    long = drift.unpivoted(reference, columns)
    counts = value_counts(long, "value", {"n": F.count(F.lit(1))}, ranges, ["feature"])
    ranked = running_totals(counts, "value", ["n"], ["feature"])
    table = ranked.select("feature", "value", "n", "n_upto", "n_total", F.col(BUCKET).alias(PART))
    table.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/values")
    stored = reference.sparkSession.read.schema(table.schema).parquet(f"{path}/values")
    stored.groupBy("feature", PART).agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum("n").alias("n"),
        F.max("n_total").alias("n_total"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/borders")


def _borders(spark: SparkSession, path: str, columns: list[str]) -> dict[str, list]:
    """Ranges of every feature in the order of their values."""
    found: dict[str, list] = {c: [] for c in columns}
    for row in spark.read.parquet(f"{path}/borders").collect():
        if row["feature"] in found:
            found[row["feature"]].append(row)
    return {c: sorted(rows, key=lambda r: r["low"]) for c, rows in found.items()}


def _batch_counts(batch: DataFrame, borders: dict[str, list]) -> DataFrame:
    """``feature, value, at, cur``: the batch's values with the place of their range, -1 before all.

    Ranges that begin at minus infinity have no place; they are opened for every batch.
    """
    columns = list(borders)
    cast = batch.select(*[F.col(c).cast("double").alias(c) for c in columns])
    names = [f"_at_{i}" for i in range(len(columns))]
    for c, name in zip(columns, names):
        splits = [-math.inf, *[r["low"] for r in borders[c] if math.isfinite(r["low"])], math.inf]
        if len(splits) == 2:
            cast = cast.withColumn(name, F.lit(0.0))
            continue
        cast = Bucketizer(inputCol=c, outputCol=name, splits=splits, handleInvalid="keep").transform(cast)
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), (F.col(n) - 1).cast("int").alias("at"))
        for c, n in zip(columns, names)
    ]
    long = cast.select(F.inline(F.array(*entries))).filter("value IS NOT NULL AND NOT isnan(value)")
    return long.groupBy("feature", "value", "at").agg(F.count(F.lit(1)).alias("cur"))


def test_against(
    spark: SparkSession, path: str, batch: DataFrame, columns: list[str], ranges: int | None = None
) -> DataFrame:
    """Two-sample statistic and p-value per feature of a batch against a kept profile."""
    borders = _borders(spark, path, columns)
    counts = settle(_batch_counts(batch, borders))
    touched = {
        (r["feature"], r["at"]) for r in counts.select("feature", "at").distinct().collect() if r["at"] >= 0
    }
    flat, opened = [], []
    for c, rows in borders.items():
        opened += [(c, r[PART]) for r in rows if not math.isfinite(r["low"])]
        for at, row in enumerate(r for r in rows if math.isfinite(r["low"])):
            if (c, at) in touched:
                opened.append((c, row[PART]))
            else:
                flat.append((c, row["high"], row["n"]))
    schema = "feature string, value double, ref long"
    entries = spark.createDataFrame(flat, schema).withColumn("cur", F.lit(0).cast("long"))
    if opened:
        wanted = spark.createDataFrame(sorted(set(opened)), f"feature string, {PART} int")
        values = spark.read.parquet(f"{path}/values").filter(
            F.col(PART).isin(sorted({part for _, part in opened}))
        )
        inside = values.join(F.broadcast(wanted), ["feature", PART]).select(
            "feature", "value", F.col("n").alias("ref"), F.lit(0).cast("long").alias("cur")
        )
        entries = entries.unionByName(inside)
    own = counts.select("feature", "value", F.lit(0).cast("long").alias("ref"), "cur")
    merged = (
        entries.unionByName(own)
        .groupBy("feature", "value")
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    ranked = running_totals(in_ranges(merged, ["feature", "value"], ranges), "value", ["ref", "cur"], ["feature"])
    return drift.tested(ranked)


def detect_against(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    columns: list[str],
    p_value: float = DRIFT_P_VALUE,
    share: float = DRIFT_SHARE,
) -> DataFrame:
    """Dataset decision for a batch, as ``drift.detect_drift`` makes it."""
    return drift.decide(
        test_against(spark, path, batch, columns),
        len(columns),
        F.col("p_value") < p_value,
        F.col("p_value"),
        F.col("num_features_drifted") > F.lit(len(columns) * share),
    )
