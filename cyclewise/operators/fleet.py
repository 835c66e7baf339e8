"""Fleet views over scored readings.

A reading has ``engine_id, cycle, max_cycle, anomaly_score, is_anomaly,
processing_time_ms, ts``. All views combine before they shuffle or keep a bounded
number of rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.constants import (
    EVENT_LOG_ROWS,
    HISTORY_ROWS,
    LATENCY_BOUNDS,
    SCORE_BOUNDS,
)
from cyclewise.functions.decisions import lifecycle_pct, unit_status
from cyclewise.operators.metrics import score_histogram


def live_readings(df: DataFrame) -> DataFrame:
    """A failed unit takes no more readings: nothing after its last cycle."""
    return df.filter(F.col("cycle") <= F.col("max_cycle"))


def with_lifecycle(df: DataFrame) -> DataFrame:
    return df.withColumn("lifecycle_pct", lifecycle_pct(F.col("cycle"), F.col("max_cycle")))


def latest_reading(df: DataFrame, order: Column | None = None) -> DataFrame:
    """The newest reading per engine."""
    place = order if order is not None else F.col("cycle")
    whole = F.struct(*[c for c in df.columns if c != "engine_id"])
    return df.groupBy("engine_id").agg(F.max_by(whole, place).alias("r")).select("engine_id", "r.*")


def _per_engine(df: DataFrame, *extra: Column) -> DataFrame:
    """Per engine the largest cycle and, as ``r``, the newest reading of its life.

    One combining aggregate, so it also runs on a stream. A failure cannot be taken
    back: it follows from the largest cycle ever seen.
    """
    alive = F.col("cycle") <= F.col("max_cycle")
    reading = F.struct("cycle", "max_cycle", "is_anomaly", "anomaly_score")
    return df.groupBy("engine_id").agg(
        F.max("cycle").alias("top"),
        F.max_by(F.when(alive, reading), F.when(alive, F.col("cycle"))).alias("r"),
        *extra,
    )


def _status() -> Column:
    return F.when(F.col("top") >= F.col("r.max_cycle"), "failed").otherwise(
        unit_status(F.col("r.cycle"), F.col("r.max_cycle"), F.col("r.is_anomaly"))
    )


def fleet_status(df: DataFrame) -> DataFrame:
    """Status of each engine after its newest reading, on a batch or a stream."""
    return _per_engine(df).select(
        "engine_id",
        "r.cycle",
        "r.max_cycle",
        lifecycle_pct(F.col("r.cycle"), F.col("r.max_cycle")).alias("lifecycle_pct"),
        "r.anomaly_score",
        _status().alias("status"),
    )


def fleet_summary(df: DataFrame, fleet: DataFrame) -> DataFrame:
    """One row per engine of the fleet list, engines without readings included."""
    alive = F.col("cycle") <= F.col("max_cycle")
    summed = _per_engine(
        df,
        F.count_if(alive).alias("readings"),
        F.count_if(alive & F.col("is_anomaly")).alias("anomalies"),
    )
    readings = F.coalesce("readings", F.lit(0))
    anomalies = F.coalesce("anomalies", F.lit(0))
    return fleet.join(summed, "engine_id", "left").select(
        "engine_id",
        F.when(F.col("r").isNotNull(), _status()).otherwise("healthy").alias("status"),
        F.coalesce("r.cycle", F.lit(0).cast("long")).alias("cycle"),
        F.round(F.col("r.cycle") / F.col("r.max_cycle") * 100, 0).alias("lifecycle_pct"),
        readings.alias("readings"),
        anomalies.alias("anomalies"),
        (100 * anomalies / F.greatest(readings, F.lit(1))).alias("anomaly_rate"),
        F.col("r.anomaly_score").alias("last_score"),
    )


def kpis(df: DataFrame) -> DataFrame:
    """Live figures in one pass: readings are summed per engine, then over the fleet."""
    alive = F.col("cycle") <= F.col("max_cycle")
    engines = _per_engine(
        df,
        F.count_if(alive).alias("n"),
        F.count_if(alive & F.col("is_anomaly")).alias("a"),
        F.sum(F.when(alive, F.col("processing_time_ms"))).alias("ms"),
    )
    return engines.agg(
        F.sum("n").alias("total_readings"),
        F.sum("a").alias("anomalies"),
        (100 * F.sum("a") / F.sum("n")).alias("anomaly_rate"),
        (F.sum("ms") / F.sum("n")).alias("avg_latency_ms"),
        F.count_if(_status().isin("critical", "failed")).alias("critical_engines"),
    )


def newest_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Newest first; every task keeps ``n`` rows only."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def latest_events(df: DataFrame, *order: str, n: int = EVENT_LOG_ROWS) -> DataFrame:
    return newest_rows(df.filter("is_anomaly"), n, *order)


def retained(df: DataFrame, *order: str, n: int = HISTORY_ROWS) -> DataFrame:
    return newest_rows(df, n, *order)


def degradation_series(df: DataFrame) -> DataFrame:
    """Score by lifecycle and by cycle for every engine; sort on read."""
    return with_lifecycle(live_readings(df)).select(
        "engine_id", "cycle", "lifecycle_pct", "anomaly_score"
    )


def degradation_buckets(df: DataFrame) -> DataFrame:
    """Mean score per whole lifecycle percent over the fleet."""
    pct = F.floor(F.col("cycle") / F.col("max_cycle") * 100)
    return (
        live_readings(df)
        .groupBy(pct.alias("pct"))
        .agg(F.avg("anomaly_score").alias("mean_score"), F.count(F.lit(1)).alias("readings"))
    )


def dashboard_histograms(df: DataFrame, bins: int = 30) -> DataFrame:
    """Score histograms of normal and anomalous readings and the latency histogram."""
    labels = F.when(F.col("is_anomaly"), "score_anomaly").otherwise("score_normal")
    scores = df.select(labels.alias("series"), F.col("anomaly_score").alias("value"))
    latency = df.select(
        F.lit("latency").alias("series"), F.col("processing_time_ms").alias("value")
    )
    return score_histogram(scores.unionByName(latency), bins, "value", "series").select(
        "series", "bin", "bin_start", "n_rows"
    )


def prediction_counters(df: DataFrame) -> DataFrame:
    return df.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("predictions"), F.count_if("is_anomaly").alias("anomalies")
    )


def anomaly_counters(df: DataFrame) -> DataFrame:
    return (
        df.filter("is_anomaly")
        .groupBy("model_version", "sensor_id")
        .agg(F.count(F.lit(1)).alias("anomalies"))
    )


def _buckets_of(value: str, bounds: list[float]) -> list[Column]:
    return [F.count_if(F.col(value) <= float(b)) for b in bounds] + [F.count(value)]


def cumulative_buckets(df: DataFrame, value: str, bounds: list[float], metric: str) -> DataFrame:
    """Counts at or below each bound plus ``+Inf``, with sum and count.

    Every bound is one counter of a single aggregate; rows are not multiplied.
    """
    counters = _buckets_of(value, bounds)
    names = [f"{float(b):g}" for b in bounds] + ["+Inf"]
    summed = df.groupBy("model_version").agg(
        *[c.alias(f"b{i}") for i, c in enumerate(counters)],
        F.sum(value).alias("value_sum"),
        F.count(value).alias("value_count"),
    )
    entries = F.array(
        *[F.struct(F.lit(n).alias("le"), F.col(f"b{i}").alias("n_le")) for i, n in enumerate(names)]
    )
    return summed.select(
        F.lit(metric).alias("metric"),
        "model_version",
        F.inline(entries),
        "value_sum",
        "value_count",
    )


def metric_buckets(df: DataFrame) -> DataFrame:
    """Latency and score buckets of the service metrics."""
    latency = cumulative_buckets(
        df, "processing_time_ms", LATENCY_BOUNDS, "anomaly_inference_latency_ms"
    )
    score = cumulative_buckets(df, "anomaly_score", SCORE_BOUNDS, "anomaly_score_distribution")
    return latency.unionByName(score)

