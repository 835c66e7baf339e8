"""Registered queries: drift and detection on streams that stop and go on."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cyclewise.functions.contracts import REASONS
from cyclewise.operators.drift_profile import save_profile
from cyclewise.operators.scoring import Detector
from cyclewise.plans import fixtures
from cyclewise.plans.registry import query, rounded, with_
from cyclewise.session import shared_dir
from cyclewise.sources import stores
from cyclewise.sources.tables import read_table
from cyclewise.streaming import jobs

#: The reference ends here; each slice of so many days is one batch of the stream.
_REFERENCE_END, _SLICE_DAYS, _SLICES = "2024-01-16", 5, 3
_CHANNELS = ["sensor_2", "sensor_3"]


@query(
    with_(
        f"""readings AS (
          SELECT CASE WHEN ts >= TIMESTAMP '{_REFERENCE_END}' THEN least({_SLICES - 1},
              CAST(floor(epoch(ts - TIMESTAMP '{_REFERENCE_END}') / {86400 * _SLICE_DAYS}) AS BIGINT)) END AS slice,
            value + 0.0 AS sensor_2, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_3 FROM events),
        sides AS (
          SELECT s.slice, 1 AS cur, CASE WHEN s.slice = 1 THEN sensor_2 * 1.3 ELSE sensor_2 END AS sensor_2, sensor_3
          FROM readings s WHERE s.slice IS NOT NULL
          UNION ALL
          SELECT n.slice, 0, sensor_2, sensor_3 FROM readings r, (SELECT unnest(range({_SLICES})) AS slice) n
          WHERE r.slice IS NULL),
        long AS (
          SELECT slice, cur, 'sensor_2' AS feature, sensor_2 AS v FROM sides
          UNION ALL SELECT slice, cur, 'sensor_3', sensor_3 FROM sides),
        counted AS (
          SELECT slice, feature, v, CAST(sum(1 - cur) AS DOUBLE) AS r, CAST(sum(cur) AS DOUBLE) AS c
          FROM long WHERE v IS NOT NULL GROUP BY slice, feature, v),
        ecdf AS (
          SELECT slice, feature, sum(r) OVER whole AS n_ref, sum(c) OVER whole AS n_cur,
            abs(sum(r) OVER upto / sum(r) OVER whole - sum(c) OVER upto / sum(c) OVER whole) AS gap
          FROM counted WINDOW whole AS (PARTITION BY slice, feature),
            upto AS (PARTITION BY slice, feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
        ks AS (
          SELECT slice, feature, max(gap) AS d, sqrt(max(n_ref) * max(n_cur) / (max(n_ref) + max(n_cur))) AS n
          FROM ecdf GROUP BY slice, feature HAVING max(n_cur) > 0 AND max(n_ref) > 0),
        tested AS (
          SELECT slice, feature, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(
              range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * x * x)
            )), 0.0), 1.0) END AS p_value
          FROM (SELECT *, (n + 0.12 + 0.11 / n) * d AS x FROM ks) scaled)""",
        select="""SELECT slice, feature, round(p_value, 6) + 0.0 AS p_value,
        sum(CAST(p_value < 0.05 AS INTEGER)) OVER (PARTITION BY slice) > 0.2 AS is_drifted FROM tested""",
    )
)
def stream_drift(spark, sf_dir):
    """Every batch of a stream against a reference that is counted once; one batch is shifted."""
    events = read_table(spark, sf_dir, "events").select(
        "ts",
        (F.col("value") + F.lit(0.0)).alias("sensor_2"),
        F.get_json_object("props", "$.k").cast("double").alias("sensor_3"),
    )
    end = F.lit(_REFERENCE_END).cast("timestamp")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(end)
    base = f"{shared_dir(spark)}/drift-{uuid.uuid4().hex}"
    save_profile(events.filter(seconds < 0), _CHANNELS, f"{base}/profile")
    shift = F.when(F.col("slice") == 1, F.col("sensor_2") * 1.3).otherwise(F.col("sensor_2"))
    later = events.filter(seconds >= 0).withColumn(
        "slice", F.least(F.lit(_SLICES - 1), F.floor(seconds / (86400 * _SLICE_DAYS)))
    )
    later = later.withColumn("sensor_2", shift)
    sink = jobs.drift_sink(f"{base}/profile", _CHANNELS, f"{base}/out")
    for piece in range(_SLICES):
        later.filter(F.col("slice") == piece).write.mode("append").parquet(f"{base}/in")
        stream = jobs.read_stream(spark, f"{base}/in", later.schema, files_per_trigger=100_000)
        jobs.start(stream, sink, f"{base}/state").awaitTermination()
    found = spark.read.parquet(f"{base}/out")
    return found.select(
        F.col("batch_id").cast("long").alias("slice"),
        F.explode("drift_scores").alias("feature", "p_value"),
        "is_drifted",
    ).withColumn("p_value", rounded("p_value"))


#: Thresholds of the two versions; the second one applies from the second batch on.
_VERSIONS = [("first-version", 0.02), ("other-version", 0.03)]


def _request_score_sql() -> str:
    terms = [f"power(e[{step * 8 + c}] - e[{32 + c}], 2)" for step in range(5, 8) for c in range(1, 9)]
    return f"({' + '.join(terms)}) / {len(terms)}"


@query(
    with_(
        f"""sent AS (
          SELECT vec_id, label, CAST(vec_id % 2 AS INTEGER) AS part,
            list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
        scored AS (
          SELECT vec_id, part, {_request_score_sql()} AS s FROM sent
          WHERE label NOT BETWEEN 1 AND 7),
        decided AS (
          SELECT *, CASE part WHEN 0 THEN {_VERSIONS[0][1]} ELSE {_VERSIONS[1][1]} END AS cut,
            CASE part WHEN 0 THEN '{_VERSIONS[0][0][:8]}' ELSE '{_VERSIONS[1][0][:8]}' END AS run FROM scored)""",
        select="""SELECT format('engine_{:03d}', vec_id) AS request, 'naive_forecast:' || run AS outcome,
          round(s, 6) + 0.0 AS anomaly_score, round(least(1.0, abs(s - cut) / cut), 6) + 0.0 AS confidence,
          CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT) + vec_id AS detected_second
        FROM decided WHERE s > cut
        UNION ALL
        SELECT CAST(vec_id AS VARCHAR), CASE label WHEN 1 THEN 'sensor_id length' WHEN 2 THEN 'sensor_id length'
          WHEN 3 THEN 'window empty' WHEN 4 THEN 'step empty' WHEN 5 THEN 'window ragged'
          WHEN 6 THEN 'value not finite' ELSE 'timestamp missing' END, NULL, NULL, NULL
        FROM sent WHERE label BETWEEN 1 AND 7""",
    )
)
def stream_detection(spark, sf_dir):
    """Requests on a stream, each sent twice: anomalies stored, bad requests quarantined.

    The detector is read from the model store at every batch; between the two batches a
    new version goes into production.
    """
    vectors = read_table(spark, sf_dir, "embeddings")
    base = f"{shared_dir(spark)}/detection-{uuid.uuid4().hex}"
    sink = jobs.detection_sink(
        lambda session: stores.production_detector(session, f"{base}/runs", f"{base}/models", "naive_forecast"),
        f"{base}/events",
        f"{base}/quarantine",
    )
    for part, (run_id, threshold) in enumerate(_VERSIONS):
        names = [f"channel_{i}" for i in range(8)]
        detector = Detector("naive_forecast", threshold, names, length=8, horizon=3, run_id=run_id)
        stores.save_detector(spark, detector, f"{base}/models/{run_id}")
        stores.append_run(spark, f"{base}/runs", run_id, "naive_forecast", {}, {})
        vectors.filter(F.col("vec_id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        stream = jobs.read_stream(spark, f"{base}/in", vectors.schema, files_per_trigger=100_000)
        twice = fixtures.requests_of(stream).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
        arrived = F.coalesce("timestamp", F.lit("2024-01-01").cast("timestamp"))
        timed = twice.withColumn("arrived", arrived).withWatermark("arrived", "3650 days")
        requests = jobs.new_requests(timed, "vec_id").drop("copy", "arrived")
        jobs.start(requests, sink, f"{base}/state").awaitTermination()
    events = stores.read_events(spark, f"{base}/events").select(
        F.col("sensor_id").alias("request"),
        F.col("model_version").alias("outcome"),
        rounded("anomaly_score").alias("anomaly_score"),
        rounded("confidence").alias("confidence"),
        F.unix_timestamp("detected_at").alias("detected_second"),
    )
    rejected = spark.read.parquet(f"{base}/quarantine").select(
        F.col("vec_id").cast("string").alias("request"),
        F.array_join(REASONS, ", ").alias("outcome"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in events.dtypes[2:]],
    )
    return events.unionByName(rejected)
