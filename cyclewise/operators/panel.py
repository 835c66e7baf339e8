"""Panel construction: remaining life, labels, event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, RUL_THRESHOLD, UNIT
from cyclewise.functions.numeric import nan_to_null
from cyclewise.operators.unit_order import SPLIT, Layout, number_rows, unit_max

START = "2024-01-01 00:00:00"


def canonical(name: str) -> Column:
    """Missing values have one form, NULL; NaN stops at the scan."""
    return nan_to_null(F.col(name)).alias(name)


def compute_rul(df: DataFrame, layout: Layout = SPLIT) -> DataFrame:
    """``rul`` = last cycle of the unit minus the current cycle."""
    with_last = unit_max(df, CYCLE, "_last", layout=layout)
    return with_last.withColumn("rul", F.col("_last") - F.col(CYCLE)).drop("_last")


def label_anomalies(
    df: DataFrame, threshold: int = RUL_THRESHOLD, layout: Layout = SPLIT
) -> DataFrame:
    labeled = df if "rul" in df.columns else compute_rul(df, layout)
    return labeled.withColumn("is_anomaly", (F.col("rul") < threshold).cast("int"))


def simulated_time(index: Column, start: str = START, interval_seconds: int = 1) -> Column:
    """Start, plus one hour per unit id above 1, plus ``interval_seconds`` per row."""
    seconds = (F.col(UNIT) - 1) * 3600 + index * F.lit(interval_seconds)
    return F.timestamp_seconds(F.unix_timestamp(F.lit(start)) + seconds)


def add_simulated_timestamps(
    df: DataFrame,
    start: str = START,
    interval_seconds: int = 1,
    index: Column | None = None,
    layout: Layout = SPLIT,
) -> DataFrame:
    """``index`` is the row index in the unit from 0, numbered here when not given."""
    if index is not None:
        return df.withColumn("timestamp", simulated_time(index, start, interval_seconds))
    numbered = number_rows(df, [CYCLE], position="_row", layout=layout)
    return numbered.withColumn(
        "timestamp", simulated_time(F.col("_row") - 1, start, interval_seconds)
    ).drop("_row")


def label_test_panel(
    df: DataFrame, rul: DataFrame, threshold: int = RUL_THRESHOLD, layout: Layout = SPLIT
) -> DataFrame:
    """Remaining life of units cut off before failure, from their last known value.

    A plain equi-join: Spark broadcasts the label list below its own threshold and
    splits skewed units above it.
    """
    with_last = unit_max(df, CYCLE, "_last", layout=layout)
    joined = with_last.join(rul, UNIT)
    return label_anomalies(
        joined.withColumn("rul", F.col("rul_last") + F.col("_last") - F.col(CYCLE)).drop(
            "_last", "rul_last"
        ),
        threshold,
    )


def unit_lengths(df: DataFrame) -> DataFrame:
    return df.groupBy(UNIT).agg(
        F.max(CYCLE).alias("max_cycle"), F.count(F.lit(1)).alias("n_rows")
    )


def unit_count(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(UNIT) if approximate else F.countDistinct(UNIT)
    return df.agg(count.alias("num_units"), F.count(F.lit(1)).alias("total_rows"))


def class_balance(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(label).cast("long").alias("n_anomaly"),
        F.avg(label).alias("anomaly_rate"),
    )
