"""Registered queries: fleet views and service counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.constants import LATENCY_BOUNDS, SCORE_BOUNDS
from cyclewise.operators import fleet
from cyclewise.plans import fixtures
from cyclewise.plans.registry import READINGS, query, rounded, rounded_all, with_

_NEWEST = """
newest AS (SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY engine_id
             ORDER BY cycle DESC) = 1)
"""
_STATUS = """CASE WHEN cycle >= max_cycle THEN 'failed'
  WHEN is_anomaly AND cycle / max_cycle > 0.9 THEN 'critical'
  WHEN is_anomaly THEN 'warning' ELSE 'healthy' END"""


@query(
    with_(
        READINGS,
        _NEWEST,
        select=f"""SELECT engine_id, cycle, max_cycle,
        round(cycle / max_cycle * 100, 1) + 0.0 AS lifecycle_pct,
        round(anomaly_score, 6) + 0.0 AS anomaly_score, {_STATUS} AS status FROM newest""",
    )
)
def fleet_status(spark, sf_dir):
    return rounded_all(fleet.fleet_status(fixtures.scored_readings(spark, sf_dir)))


@query(
    with_(
        READINGS,
        _NEWEST,
        """summed AS (SELECT engine_id, count(*) AS readings,
             count(*) FILTER (WHERE is_anomaly) AS anomalies FROM live GROUP BY engine_id),
           fleet AS (SELECT format('engine_{:03d}', c_custkey) AS engine_id FROM customer)""",
        select=f"""SELECT f.engine_id, CASE WHEN n.engine_id IS NULL THEN 'healthy'
          ELSE {_STATUS} END AS status, coalesce(cycle, 0) AS cycle,
        round(cycle / max_cycle * 100, 0) + 0.0 AS lifecycle_pct,
        coalesce(readings, 0) AS readings, coalesce(anomalies, 0) AS anomalies,
        round(100.0 * coalesce(anomalies, 0) / greatest(coalesce(readings, 0), 1), 6) + 0.0
          AS anomaly_rate, round(anomaly_score, 6) + 0.0 AS last_score
        FROM fleet f LEFT JOIN newest n ON f.engine_id = n.engine_id
        LEFT JOIN summed s ON f.engine_id = s.engine_id""",
    )
)
def fleet_summary(spark, sf_dir):
    return rounded_all(
        fleet.fleet_summary(
            fixtures.scored_readings(spark, sf_dir), fixtures.fleet_list(spark, sf_dir)
        )
    )


@query(
    with_(
        READINGS,
        _NEWEST,
        select=f"""SELECT count(*) AS total_readings,
        count(*) FILTER (WHERE is_anomaly) AS anomalies,
        round(100.0 * count(*) FILTER (WHERE is_anomaly) / count(*), 6) + 0.0 AS anomaly_rate,
        round(sum(processing_time_ms) / count(*), 6) + 0.0 AS avg_latency_ms,
        (SELECT count(*) FROM newest WHERE {_STATUS} IN ('critical', 'failed'))
          AS critical_engines FROM live""",
    )
)
def kpis(spark, sf_dir):
    return rounded_all(fleet.kpis(fixtures.scored_readings(spark, sf_dir)))


@query(
    with_(
        READINGS,
        _NEWEST,
        select="""SELECT engine_id, event_id, CAST(epoch_us(ts) AS BIGINT) AS ts_us, cycle,
        model_version FROM readings QUALIFY row_number() OVER (PARTITION BY engine_id
        ORDER BY cycle DESC) = 1""",
    )
)
def latest_reading(spark, sf_dir):
    newest = fleet.latest_reading(fixtures.scored_readings(spark, sf_dir))
    return newest.select(
        "engine_id", "event_id", F.unix_micros("ts").alias("ts_us"), "cycle", "model_version"
    )


@query(
    with_(
        READINGS,
        select="""SELECT engine_id, event_id, cycle, round(anomaly_score, 6) + 0.0
        AS anomaly_score FROM readings WHERE is_anomaly ORDER BY ts DESC, event_id DESC LIMIT 50""",
    )
)
def latest_events(spark, sf_dir):
    newest = fleet.latest_events(fixtures.scored_readings(spark, sf_dir), "ts", "event_id")
    return rounded_all(newest.select("engine_id", "event_id", "cycle", "anomaly_score"))


@query(
    with_(
        READINGS,
        select="""SELECT engine_id, event_id, cycle FROM readings
        ORDER BY ts DESC, event_id DESC LIMIT 2000""",
    )
)
def retention(spark, sf_dir):
    kept = fleet.retained(fixtures.scored_readings(spark, sf_dir), "ts", "event_id")
    return kept.select("engine_id", "event_id", "cycle")


@query(
    with_(
        READINGS,
        select="""SELECT engine_id, cycle, round(cycle / max_cycle * 100, 1) + 0.0
        AS lifecycle_pct, round(anomaly_score, 6) + 0.0 AS anomaly_score FROM live""",
    )
)
def degradation_series(spark, sf_dir):
    return rounded_all(fleet.degradation_series(fixtures.scored_readings(spark, sf_dir)))


@query(
    with_(
        READINGS,
        select="""SELECT CAST(floor(cycle / max_cycle * 100) AS BIGINT) AS pct,
        round(avg(anomaly_score), 12) + 0.0 AS mean_score, count(*) AS readings
        FROM live GROUP BY 1""",
    )
)
def degradation_buckets(spark, sf_dir):
    return rounded_all(fleet.degradation_buckets(fixtures.scored_readings(spark, sf_dir)), 12)


@query(
    with_(
        READINGS,
        """v AS (SELECT CASE WHEN is_anomaly THEN 'score_anomaly' ELSE 'score_normal' END AS series,
             anomaly_score AS x FROM readings
           UNION ALL SELECT 'latency', processing_time_ms FROM readings),
           spans AS (SELECT series, min(x) AS lo, max(x) AS hi FROM v GROUP BY series)""",
        select="""SELECT v.series, CAST(least(greatest(floor((x - lo) / (hi - lo) * 30), 0), 29)
          AS INTEGER) AS bin, round(any_value(lo + least(greatest(floor((x - lo) / (hi - lo) * 30),
          0), 29) * ((hi - lo) / 30)), 6) + 0.0 AS bin_start, count(*) AS n_rows
        FROM v JOIN spans s ON v.series = s.series GROUP BY 1, 2""",
    )
)
def dashboard_histograms(spark, sf_dir):
    return rounded_all(fleet.dashboard_histograms(fixtures.scored_readings(spark, sf_dir)))


@query(
    with_(
        READINGS,
        select="""SELECT model_version, count(*) AS predictions,
        count(*) FILTER (WHERE is_anomaly) AS anomalies FROM readings GROUP BY model_version""",
    )
)
def counters(spark, sf_dir):
    return fleet.prediction_counters(fixtures.scored_readings(spark, sf_dir))


@query(
    with_(
        READINGS,
        select="""SELECT model_version, sensor_id, count(*) AS anomalies FROM readings
        WHERE is_anomaly GROUP BY model_version, sensor_id""",
    )
)
def anomaly_counters(spark, sf_dir):
    return fleet.anomaly_counters(fixtures.scored_readings(spark, sf_dir))


def _bucket_sql(metric, column, bounds):
    parts = [(f"{float(b):g}", f"{column} <= {float(b)}") for b in bounds] + [("+Inf", "true")]
    return " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, model_version, '{le}' AS le, "
        f"count(*) FILTER (WHERE {test}) AS n_le, round(sum({column}), 6) + 0.0 AS value_sum, "
        f"count(*) AS value_count FROM readings GROUP BY model_version"
        for le, test in parts
    )


@query(
    with_(
        READINGS,
        select=_bucket_sql("anomaly_inference_latency_ms", "processing_time_ms", LATENCY_BOUNDS)
        + " UNION ALL "
        + _bucket_sql("anomaly_score_distribution", "anomaly_score", SCORE_BOUNDS),
    )
)
def prom_buckets(spark, sf_dir):
    return rounded_all(fleet.metric_buckets(fixtures.scored_readings(spark, sf_dir)))


@query(
    with_(
        READINGS,
        select="""SELECT CASE WHEN is_anomaly THEN 1 ELSE 0 END AS part, event_id AS sequence,
        round(anomaly_score, 6) + 0.0 AS anomaly_score FROM readings""",
    )
)
def concatenated_batches(spark, sf_dir):
    """Two result batches as one, their order kept as a column."""
    rows = fixtures.scored_readings(spark, sf_dir)

    def part(number, condition):
        return rows.filter(condition).select(
            F.lit(number).alias("part"),
            F.col("event_id").alias("sequence"),
            rounded("anomaly_score").alias("anomaly_score"),
        )

    return part(0, "NOT is_anomaly").unionByName(part(1, "is_anomaly"))
