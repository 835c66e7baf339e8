"""Registered queries: fitted scorers, batch scoring, event store and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, UNIT, WINDOW_SIZE
from cyclewise.functions.decisions import engine_name
from cyclewise.operators import features, scalers
from cyclewise.operators.models.forecast import fit_ridge, naive_error
from cyclewise.operators.models.forest import fit_and_score
from cyclewise.operators.models.reconstruction import fit_reconstruction, reconstruction_error
from cyclewise.operators.scoring import Detector, anomalies_only, decide, detect
from cyclewise.plans import fixtures, training
from cyclewise.plans.registry import (
    READINGS,
    SUPPLIER_PANEL,
    USER_PANEL,
    query,
    rounded,
    rounded_all,
    with_,
)
from cyclewise.plans.feature_queries import ROLLED_SQL, ROLLED_NAMES, round_list
from cyclewise.plans.metric_queries import SWEEP_SQL
from cyclewise.plans.panel_queries import SPLIT_SQL
from cyclewise.session import shared_dir, stored
from cyclewise.sources.stores import read_events, write_event_batch
from cyclewise.sources.tables import read_table
from cyclewise.streaming import jobs, status
from cyclewise.streaming.processor import stream_features

_LAGS = "(PARTITION BY unit_id ORDER BY time_cycles)"


def _naive_sql(value):
    """Mean squared difference of the last ten steps to the step before them."""
    terms = " + ".join(
        f"power(lag({value}, {k}) OVER u - lag({value}, 10) OVER u, 2)" for k in range(10)
    )
    return f"({terms}) / 10"


@query(
    with_(
        USER_PANEL,
        f"scored AS (SELECT unit_id, time_cycles, is_anomaly AS label, {_naive_sql('sensor_2')} "
        f"AS score FROM user_panel WINDOW u AS {_LAGS})",
        select="""SELECT unit_id, time_cycles, label, round(score, 6) + 0.0 AS score
        FROM scored WHERE time_cycles >= 30""",
    )
)
def naive_forecast_score(spark, sf_dir):
    panel, layout = fixtures.user_readings(spark, sf_dir)
    built = features.sliding_windows(panel, ["sensor_2"], position=CYCLE, layout=layout)
    return built.select(
        UNIT, CYCLE, "label", rounded(naive_error(F.col("window"), 30)).alias("score")
    )


_P2 = list(fixtures.SUPPLIER_SENSORS)


@query(
    with_(
        SUPPLIER_PANEL,
        f"fitted AS (SELECT {', '.join(f'min({c}) AS {c}_lo, max({c}) AS {c}_hi' for c in _P2)} "
        "FROM supplier_panel)",
        "scaled AS (SELECT unit_id, time_cycles, "
        + ", ".join(f"({c} - {c}_lo) / ({c}_hi - {c}_lo) AS {c}" for c in _P2)
        + " FROM supplier_panel, fitted)",
        "scored AS (SELECT unit_id, time_cycles, ("
        + " + ".join(_naive_sql(c) for c in _P2)
        + f") / 4 AS s FROM scaled WINDOW u AS {_LAGS})",
        select="""SELECT format('engine_{:03d}', unit_id) AS sensor_id, time_cycles,
        round(s, 6) + 0.0 AS anomaly_score, s > 0.15 AS is_anomaly,
        round(least(1.0, abs(s - 0.15) / 0.15), 6) + 0.0 AS confidence,
        'naive_forecast:local' AS model_version FROM scored WHERE time_cycles >= 30""",
    )
)
def naive_batch_scoring(spark, sf_dir):
    """Raw windows of four channels through the whole scoring chain."""
    rows, layout = fixtures.supplier_panel(spark, sf_dir)
    detector = Detector("naive_forecast", 0.15, _P2, scalers.fit_scaler(rows, columns=_P2))
    raw = features.sliding_windows(rows, _P2, position=CYCLE, layout=layout)
    named = raw.select(engine_name(F.col(UNIT)).alias("sensor_id"), CYCLE, "window")
    return rounded_all(detect(named, detector))


def _summaries(spark, sf_dir):
    rows, layout = fixtures.supplier_panel(spark, sf_dir)
    table = features.window_summary(rows, _P2, position=CYCLE, layout=layout)
    names = [f"{c}_{n}" for n in ("mean", "std") for c in _P2]
    return table.select(UNIT, CYCLE, "label", F.array(*names).alias("features"))


@query()
def iforest_scores(spark, sf_dir):
    vectors = stored(_summaries(spark, sf_dir))
    return rounded_all(fit_and_score(vectors, [UNIT, CYCLE])[1])


@query()
def pca_reconstruction(spark, sf_dir):
    panel, layout = fixtures.user_readings(spark, sf_dir)
    rows = features.sliding_windows(panel, ["sensor_2"], position=CYCLE, layout=layout).select(UNIT, CYCLE, "label", F.flatten("window").alias("features"))
    model = fit_reconstruction(rows.filter("label = 0"), 30, latent=8)
    return rounded_all(
        reconstruction_error(rows, model).select(UNIT, CYCLE, "label", "score")
    )


@query()
def vector_reconstruction(spark, sf_dir):
    """Reconstruction error of the stored vectors."""
    rows = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("features")
    )
    model = fit_reconstruction(rows, 64)
    return rounded_all(reconstruction_error(rows, model).select("vec_id", "score"))


@query()
def ridge_forecast(spark, sf_dir):
    panel, layout = fixtures.supplier_panel(spark, sf_dir)
    rows = features.sliding_windows(panel, _P2, position=CYCLE, layout=layout)
    model = fit_ridge(rows)
    return rows.select(
        UNIT, CYCLE, "label", rounded(model.error(spark, F.col("window")), 2).alias("score")
    )


@query(
    with_(
        USER_PANEL,
        SPLIT_SQL,
        """tagged AS (SELECT u.unit_id, time_cycles, is_anomaly, split, sensor_2
             FROM user_panel u JOIN unit_split s ON u.unit_id = s.unit_id),
           fitted AS (SELECT min(sensor_2) AS lo, max(sensor_2) AS hi FROM tagged
             WHERE split = 'train'),
           scaled AS (SELECT unit_id, time_cycles, is_anomaly, split,
             (sensor_2 - lo) / (hi - lo) AS v FROM tagged, fitted)""",
        f"""scored AS (SELECT unit_id, time_cycles, split, is_anomaly AS label,
             {_naive_sql('v')} AS score FROM scaled WINDOW u AS {_LAGS}),
           scores AS (SELECT score, label FROM scored WHERE split = 'val' AND time_cycles >= 30)""",
        SWEEP_SQL,
        """best AS (SELECT threshold, f1 FROM sweep WHERE tp + fp > 0 AND tp + fp < n
             ORDER BY f1 DESC, step LIMIT 1),
           tested AS (SELECT count(*) FILTER (WHERE label = 1 AND score > threshold) AS tp,
             count(*) FILTER (WHERE label = 0 AND score > threshold) AS fp,
             count(*) FILTER (WHERE label = 1 AND score <= threshold) AS fn
             FROM scored, best WHERE split = 'test' AND time_cycles >= 30)""",
        select="""SELECT round(threshold, 6) + 0.0 AS threshold, round(f1, 6) + 0.0 AS val_f1,
        round(2.0 * tp / (2 * tp + fp + fn), 6) + 0.0 AS test_f1,
        round(tp / (tp + fp), 6) + 0.0 AS test_precision,
        round(tp / (tp + fn), 6) + 0.0 AS test_recall FROM best, tested""",
    )
)
def model_selection(spark, sf_dir):
    """Split by unit, scale on train, threshold on validation, metrics on test."""
    rows, layout = fixtures.user_readings(spark, sf_dir)
    prepared = training.prepare(rows, position=CYCLE, layout=layout)
    _, reported = training.train_and_select(prepared, "naive_forecast")
    names = ["threshold", "val_f1", "test_f1", "test_precision", "test_recall"]
    one = spark.range(1)
    return one.select(*[rounded(F.lit(reported[n])).alias(n) for n in names])


_STORED = """
stored AS (SELECT sensor_id, ts, anomaly_score, least(1.0, abs(anomaly_score - 0.2) / 0.2)
             AS confidence FROM readings WHERE anomaly_score > 0.2)
"""


@query(
    with_(
        READINGS,
        _STORED,
        select="""SELECT strftime(ts, '%Y-%m-%d') AS detected_date, count(*) AS n_events,
        round(sum(anomaly_score), 6) + 0.0 AS score_sum, round(min(confidence), 6) + 0.0
        AS min_confidence FROM stored GROUP BY 1""",
    )
)
def event_store(spark, sf_dir):
    """Anomalies written as one event batch, twice, and read back by date."""
    scored = fixtures.scored_readings(spark, sf_dir).select(
        "sensor_id", F.col("ts").alias("detected_at"), "anomaly_score"
    )
    events = anomalies_only(decide(scored, fixtures.ALARM, "naive_forecast:local"))
    path = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    for _ in range(2):
        write_event_batch(events, path, 0)
    return (
        read_events(spark, path)
        .groupBy(F.col("detected_date").cast("string").alias("detected_date"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            rounded(F.sum("anomaly_score")).alias("score_sum"),
            rounded(F.min("confidence")).alias("min_confidence"),
        )
    )


# Streams over the events file, drained and read back


def _event_stream(spark, sf_dir, delay="1 hour"):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return jobs.in_event_time(jobs.read_stream(spark, sf_dir, schema, "events.parquet"), delay=delay)


@query(
    with_(
        USER_PANEL,
        ROLLED_SQL,
        select=f"""SELECT unit_id, time_cycles, event_id, time_cycles >= 30 AS has_window,
        {round_list(ROLLED_NAMES)} FROM rolled""",
    )
)
def stream_windows(spark, sf_dir):
    """Rolling features and windows from the keyed stream; the same rows as the batch."""
    readings = _event_stream(spark, sf_dir, "0 seconds").select(
        F.col("user_id").alias(UNIT), "ts", "event_id", F.col("value").alias("sensor_2")
    )
    out = jobs.drain(stream_features(readings, ["sensor_2"], window=WINDOW_SIZE))
    return rounded_all(
        out.filter("NOT is_late").select(
            UNIT,
            CYCLE,
            F.col("tie").alias("event_id"),
            F.col("window").isNotNull().alias("has_window"),
            *ROLLED_NAMES,
        )
    )


#: Arrival of the readings: six-day slices of event time; some come a slice later, some two.
_ARRIVAL_DAYS, _ARRIVALS, _LATE_DELAY_DAYS = 6, 5, 7
_ARRIVAL_START = "2024-01-01"


def _arrival_sql():
    slice_of = f"CAST(floor(epoch(ts - TIMESTAMP '{_ARRIVAL_START}') / {86400 * _ARRIVAL_DAYS}) AS BIGINT)"
    return f"""
    sent AS (
      SELECT user_id AS unit_id, event_id, ts, value + 0.0 AS sensor_2,
        least({_ARRIVALS - 1}, greatest(0, {slice_of})
          + CASE WHEN event_id % 97 = 0 THEN 2 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS arrival
      FROM events),
    tops AS (SELECT arrival, max(epoch_ms(ts)) - {_LATE_DELAY_DAYS * 86_400_000} AS top FROM sent GROUP BY arrival),
    marks AS (
      SELECT a.arrival, max(b.top) AS passed
      FROM tops a LEFT JOIN tops b ON b.arrival < a.arrival GROUP BY a.arrival),
    timed AS (
      SELECT s.*, passed IS NOT NULL AND epoch_ms(ts) <= passed AS is_late FROM sent s JOIN marks USING (arrival)),
    ordered AS (
      SELECT unit_id, event_id, ts, sensor_2, row_number() OVER u AS time_cycles,
        avg(sensor_2) OVER w AS mean_5, coalesce(stddev_samp(sensor_2) OVER w, 0.0) AS std_5
      FROM timed WHERE NOT is_late
      WINDOW u AS (PARTITION BY unit_id ORDER BY ts, event_id),
        w AS (PARTITION BY unit_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
    """


@query(
    with_(
        _arrival_sql(),
        select=f"""SELECT unit_id, event_id, time_cycles, round(mean_5, 6) + 0.0 AS mean_5,
        round(std_5, 6) + 0.0 AS std_5, false AS is_late FROM ordered
        WHERE epoch_ms(ts) <= (SELECT max(top) FROM tops)
        UNION ALL SELECT unit_id, event_id, NULL, NULL, NULL, true FROM timed WHERE is_late""",
    )
)
def stream_late_rows(spark, sf_dir):
    """Readings that arrive out of order: in time within the delay, quarantined beyond it.

    The stream is stopped and started again after every arrival. Readings of the last
    delay still wait for the watermark when the input ends.
    """
    events = read_table(spark, sf_dir, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(
        F.lit(_ARRIVAL_START).cast("timestamp")
    )
    delayed = F.when(F.col("event_id") % 97 == 0, 2).when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    own = F.greatest(F.lit(0), F.floor(seconds / (86400 * _ARRIVAL_DAYS)))
    sent = events.withColumn("arrival", F.least(F.lit(_ARRIVALS - 1), own + delayed))
    base = f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"
    for arrival in range(_ARRIVALS):
        sent.filter(F.col("arrival") == arrival).write.mode("append").parquet(f"{base}/in")
        stream = jobs.read_stream(spark, f"{base}/in", sent.schema, files_per_trigger=100_000)
        readings = jobs.in_event_time(stream, delay=f"{_LATE_DELAY_DAYS} days").select(
            F.col("user_id").alias(UNIT), "ts", "event_id", F.col("value").alias("sensor_2")
        )
        featured = stream_features(readings, ["sensor_2"], sizes=[5])
        jobs.start(featured, jobs.to_parquet(f"{base}/out"), f"{base}/state").awaitTermination()
    return rounded_all(
        spark.read.parquet(f"{base}/out").select(
            UNIT,
            F.col("tie").alias("event_id"),
            CYCLE,
            F.col("sensor_2_rolling_mean_5").alias("mean_5"),
            F.col("sensor_2_rolling_std_5").alias("std_5"),
            "is_late",
        )
    )


@query(
    with_(
        READINGS,
        select="""SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_second,
        model_version, count(*) AS predictions, count(*) FILTER (WHERE is_anomaly) AS anomalies,
        round(sum(anomaly_score), 6) + 0.0 AS score_sum FROM readings GROUP BY 1, 2""",
    )
)
def stream_counters(spark, sf_dir):
    scored = _event_stream(spark, sf_dir).select(
        "ts",
        F.concat("event_type", F.lit(":local")).alias("model_version"),
        (F.col("value") / 600).alias("anomaly_score"),
        (F.col("value") / 600 > fixtures.ALARM).alias("is_anomaly"),
    )
    out = jobs.drain(jobs.counters_over_time(scored, "1 day"), "complete")
    return out.select(
        F.unix_timestamp("window_start").alias("window_second"),
        "model_version",
        "predictions",
        "anomalies",
        rounded("score_sum").alias("score_sum"),
    )


@query(
    """SELECT user_id AS unit_id, event_id, CAST(epoch_us(ts) AS BIGINT) AS ts_us FROM events"""
)
def stream_distinct(spark, sf_dir):
    """Every reading sent twice, repeats dropped within the watermark."""
    events = _event_stream(spark, sf_dir)
    doubled = events.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    out = jobs.drain(jobs.without_repeats(doubled, ["user_id", "event_id"]))
    return out.select(
        F.col("user_id").alias(UNIT), "event_id", F.unix_micros("ts").alias("ts_us")
    )


@query(
    with_(
        READINGS,
        """newest AS (SELECT * FROM (SELECT *, max(ts) OVER (PARTITION BY engine_id) AS last_ts
             FROM readings) r WHERE ts <= TIMESTAMP '2024-01-30'
             QUALIFY row_number() OVER (PARTITION BY engine_id ORDER BY ts DESC) = 1)""",
        select="""SELECT engine_id, CAST(epoch_us(ts) AS BIGINT) AS cycle,
        CAST(epoch_us(TIMESTAMP '2024-01-30') AS BIGINT) AS max_cycle,
        round(epoch_us(ts) / epoch_us(TIMESTAMP '2024-01-30') * 100, 1) + 0.0 AS lifecycle_pct,
        round(anomaly_score, 6) + 0.0 AS anomaly_score,
        CASE WHEN last_ts >= TIMESTAMP '2024-01-30' THEN 'failed'
          WHEN is_anomaly THEN 'critical' ELSE 'healthy' END AS status FROM newest""",
    )
)
def stream_status(spark, sf_dir):
    """Newest status per engine from a log of changes; the cycle is the event time here."""
    end = F.unix_micros(F.lit("2024-01-30").cast("timestamp"))
    readings = _event_stream(spark, sf_dir).select(
        engine_name(F.col("user_id")).alias("engine_id"),
        F.unix_micros("ts").alias("cycle"),
        end.alias("max_cycle"),
        (F.col("value") / 600).alias("anomaly_score"),
        (F.col("value") / 600 > fixtures.ALARM).alias("is_anomaly"),
        "ts",
    )
    base = f"{shared_dir(spark)}/status-{uuid.uuid4().hex}"
    changes = status.status_changes(readings, "ts")
    jobs.start(changes, status.to_log(f"{base}/log"), f"{base}/state", "update").awaitTermination()
    return rounded_all(status.current_status(spark, f"{base}/log"))
