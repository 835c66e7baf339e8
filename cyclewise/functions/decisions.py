"""Decision, confidence and status expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_above(score: Column, threshold: Column) -> Column:
    return score > threshold


def confidence(score: Column, threshold: Column) -> Column:
    """Distance to the threshold relative to it, at most 1; 0.5 without a usable threshold."""
    return F.when(
        threshold > 0, F.least(F.lit(1.0), F.abs(score - threshold) / threshold)
    ).otherwise(F.lit(0.5))


def lifecycle_pct(cycle: Column, max_cycle: Column) -> Column:
    return F.round(cycle / max_cycle * 100, 1)


def unit_status(cycle: Column, max_cycle: Column, anomaly: Column) -> Column:
    """The end of life overrides the score; late anomalies are critical."""
    return (
        F.when(cycle >= max_cycle, "failed")
        .when(anomaly & (cycle / max_cycle > 0.9), "critical")
        .when(anomaly, "warning")
        .otherwise("healthy")
    )


def engine_name(unit_id: Column) -> Column:
    return F.format_string("engine_%03d", unit_id)
