"""Row contracts: each gives an array of the reasons a row is rejected for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, MAX_SENSOR_ID, UNIT
from cyclewise.functions.numeric import is_finite, is_missing

REASONS = "reasons"


def reasons(*rules: tuple[Column, str]) -> Column:
    """Names of the rules that fail; a rule that is NULL counts as failed."""
    listed = [
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in rules
    ]
    return F.filter(F.array(*listed), lambda r: r.isNotNull())


def reading_rules(columns: list[str]) -> list[tuple[Column, str]]:
    """Contract of a raw reading, plus the labels when the frame has all three."""
    rules = [(F.col(c) >= 1, f"{c} below 1") for c in (UNIT, CYCLE)]
    measured = [c for c in columns if c.startswith(("sensor_", "op_setting_"))]
    rules += [(~is_missing(F.col(c)), f"{c} missing") for c in measured]
    if {"rul", "is_anomaly", "timestamp"} <= set(columns):
        rules += [
            (F.col("rul") >= 0, "rul negative"),
            (F.col("is_anomaly").isin(0, 1), "is_anomaly not binary"),
            (F.col("timestamp").isNotNull(), "timestamp missing"),
        ]
    return rules


def reading_reasons(columns: list[str]) -> Column:
    return reasons(*reading_rules(columns))


def request_reasons(sensor_id: Column, window: Column, timestamp: Column) -> Column:
    """Contract of a detection request.

    ``get`` keeps the check legal under ANSI mode, where ``window[0]`` of an empty
    array is an error.
    """
    first = F.size(F.get(window, F.lit(0)))
    filled = F.size(window) > 0
    return reasons(
        (F.length(sensor_id).between(1, MAX_SENSOR_ID), "sensor_id length"),
        (timestamp.isNotNull(), "timestamp missing"),
        (filled, "window empty"),
        (~filled | (first > 0), "step empty"),
        (F.forall(window, lambda step: F.size(step) == first), "window ragged"),
        (F.forall(F.flatten(window), is_finite), "value not finite"),
    )


def result_reasons() -> Column:
    """Contract of a detection result."""
    return reasons(
        (F.col("anomaly_score") >= 0, "anomaly_score negative"),
        (F.col("confidence").between(0, 1), "confidence outside 0..1"),
        (F.col("is_anomaly").isNotNull(), "is_anomaly missing"),
        (F.length("model_version") > 0, "model_version missing"),
    )


def split_valid(df: DataFrame, why: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their reasons."""
    checked = df.withColumn(REASONS, why)
    good = checked.filter(F.size(REASONS) == 0).drop(REASONS)
    bad = checked.filter(F.size(REASONS) > 0)
    return good, bad

