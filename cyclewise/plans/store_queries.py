"""Registered queries: text files, model store, event table, evaluation bundle, fitted scorers."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, OP_SETTINGS, SENSORS, UNIT
from cyclewise.functions.decisions import engine_name
from cyclewise.operators import features, metrics, panel, scalers
from cyclewise.operators.models.forecast import fit_ridge
from cyclewise.operators.models.forest import fit_and_score
from cyclewise.operators.models.reconstruction import fit_reconstruction, reconstruction_error
from cyclewise.operators.scoring import Detector, decide, score
from cyclewise.plans import fixtures
from cyclewise.plans.metric_queries import SWEEP_SQL
from cyclewise.plans.registry import READINGS, SCORES, SUPPLIER_PANEL, VECTOR_PANEL, query, rounded, rounded_all, with_
from cyclewise.session import settle, shared_dir
from cyclewise.sources import stores
from cyclewise.sources.panel_text import ingest_test, ingest_train, write_checked
from cyclewise.sources.tables import read_table

_NAMES = [*OP_SETTINGS, *SENSORS]


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _write_panel(rows: DataFrame, path: str) -> None:
    """Panel rows as a text file: unit, cycle and 24 numbers, apart by one blank or two."""
    numbers = [F.format_string("%.4f", c) for c in _NAMES]
    rows.select(F.concat_ws("  ", F.concat_ws(" ", UNIT, CYCLE), *numbers, F.lit(""))).write.text(path)


_FULL_PANEL = (
    f"{VECTOR_PANEL}, lives AS (SELECT unit_id, max(time_cycles) AS life FROM vector_panel GROUP BY unit_id)"
)


def _full_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.vector_panel(spark, sf_dir)[0]


_ROUNDED_SQL = ", ".join(f"round({c}, 4) + 0.0 AS {c}" for c in _NAMES)


@query(
    with_(
        _FULL_PANEL,
        select=f"""SELECT unit_id, time_cycles, {_ROUNDED_SQL}, life - time_cycles AS rul,
        CAST(life - time_cycles < 30 AS INTEGER) AS is_anomaly,
        CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT) + (unit_id - 1) * 3600 + time_cycles - 1 AS event_second
        FROM vector_panel JOIN lives USING (unit_id)""",
    )
)
def train_ingest(spark, sf_dir):
    """A written text file through the whole training ingest."""
    path = _folder(spark, "train")
    _write_panel(_full_panel(spark, sf_dir), path)
    frame = ingest_train(spark, path)
    return rounded_all(
        frame.withColumn("event_second", F.unix_timestamp("timestamp")).drop("timestamp"), 4
    )


@query(
    with_(
        _FULL_PANEL,
        select=f"""SELECT unit_id, time_cycles, {_ROUNDED_SQL},
        (unit_id * 37) % 90 + 5 + life - time_cycles AS rul,
        CAST((unit_id * 37) % 90 + 5 + life - time_cycles < 30 AS INTEGER) AS is_anomaly,
        CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT) + (unit_id - 1) * 3600 + time_cycles - 1 AS event_second
        FROM vector_panel JOIN lives USING (unit_id)""",
    )
)
def cutoff_ingest(spark, sf_dir):
    """Panel and label files of cut-off units: lines count as units, labels follow from the last."""
    path, lives = _folder(spark, "test"), _folder(spark, "lives")
    rows = _full_panel(spark, sf_dir)
    _write_panel(rows, path)
    units = rows.select(UNIT).distinct().orderBy(UNIT)
    units.select(((F.col(UNIT) * 37) % 90 + 5).cast("string")).write.text(lives)
    frame, labels = ingest_test(spark, path, lives)
    labeled = panel.label_test_panel(frame, labels)
    return rounded_all(
        labeled.withColumn("event_second", F.unix_timestamp("timestamp"))
        .drop("timestamp")
        .select(UNIT, CYCLE, *_NAMES, "rul", "is_anomaly", "event_second"),
        4,
    )


@query(
    with_(
        _FULL_PANEL,
        """holed AS (SELECT * FROM vector_panel WHERE time_cycles % 17 <> 0),
        sent AS (
          SELECT *, CASE WHEN time_cycles % 29 = 0 THEN 'NaN'::DOUBLE ELSE sensor_4 END AS s4 FROM holed
          UNION ALL
          SELECT *, CASE WHEN time_cycles % 29 = 0 THEN 'NaN'::DOUBLE ELSE sensor_4 END FROM holed
          WHERE time_cycles % 23 = 0),
        stepped AS (SELECT *, lag(time_cycles) OVER (PARTITION BY unit_id ORDER BY time_cycles) AS before FROM sent),
        facts AS (
          SELECT count(*) AS n, count(*) FILTER (WHERE isnan(s4)) AS holes,
            count(*) FILTER (WHERE time_cycles = before) AS again,
            count(*) FILTER (WHERE time_cycles - before > 1) AS gaps FROM stepped)""",
        select="""SELECT 0 AS position, 'columns_present' AS name, true AS passed, '' AS detail, n AS stored FROM facts
        UNION ALL SELECT 1, 'no_nulls', holes = 0,
          CASE WHEN holes > 0 THEN holes || ' nulls in columns: [''sensor_4'']' ELSE '' END, n FROM facts
        UNION ALL SELECT 2, 'repeated_keys', again = 0, CASE WHEN again > 0 THEN again || ' repeated rows' ELSE '' END, n
          FROM facts
        UNION ALL SELECT 3, 'column_types', true, '', n FROM facts
        UNION ALL SELECT 4, 'value_ranges', true, '', n FROM facts
        UNION ALL SELECT 5, 'cycle_gaps', gaps = 0, CASE WHEN gaps > 0 THEN gaps || ' rows behind a gap' ELSE '' END, n
          FROM facts
        UNION ALL SELECT 6, 'rul_non_negative', true, '', n FROM facts
        UNION ALL SELECT 7, 'anomaly_binary', true, '', n FROM facts
        UNION ALL SELECT 8, 'schema_validation', holes = 0,
          CASE WHEN holes > 0 THEN holes || '/' || n || ' rows failed' ELSE '' END, n FROM facts""",
    )
)
def checked_ingest(spark, sf_dir):
    """A file with holes, repeats and missing numbers, ingested and checked in one pass over its rows."""
    path, out = _folder(spark, "checked"), _folder(spark, "panel")
    rows = _full_panel(spark, sf_dir).filter(F.col(CYCLE) % 17 != 0)
    missing = F.when(F.col(CYCLE) % 29 == 0, F.lit(float("nan"))).otherwise(F.col("sensor_4"))
    rows = rows.withColumn("sensor_4", missing)
    _write_panel(rows.unionByName(rows.filter(F.col(CYCLE) % 23 == 0)), path)
    found = write_checked(spark, path, out)
    return found.withColumn("stored", F.lit(spark.read.parquet(out).count()).cast("long"))


@query(
    with_(
        SUPPLIER_PANEL,
        """ranges AS (SELECT min(sensor_2) AS lo, max(sensor_2) AS hi FROM supplier_panel),
        scaled AS (SELECT unit_id, time_cycles, (sensor_2 - lo) / (hi - lo) AS v FROM supplier_panel, ranges),
        pairs AS (SELECT *, lag(v) OVER (PARTITION BY unit_id ORDER BY time_cycles) AS x FROM scaled),
        moments AS (SELECT count(*) AS n, avg(x) AS mx, avg(v) AS my FROM pairs WHERE x IS NOT NULL),
        fitted AS (
          SELECT sum((x - mx) * (v - my)) / (sum((x - mx) * (x - mx)) + 1e-6 * max(n)) AS b, max(mx) AS mx, max(my) AS my
          FROM pairs, moments WHERE x IS NOT NULL)""",
        select="""SELECT format('engine_{:03d}', unit_id) AS sensor_id, time_cycles,
        round(power(v - (my + b * (x - mx)), 2), 6) + 0.0 AS anomaly_score,
        power(v - (my + b * (x - mx)), 2) > 0.2 AS is_anomaly, 'forecast:ridge-on' AS model_version
        FROM pairs, fitted WHERE x IS NOT NULL""",
    )
)
def detector_store(spark, sf_dir):
    """A forecast of one step from one lag: fitted, stored with scaler and threshold, read back, applied."""
    rows, layout = fixtures.supplier_panel(spark, sf_dir)
    rows = settle(rows)
    scaler = scalers.fit_scaler(rows, columns=["sensor_2"])
    raw = features.sliding_windows(rows, ["sensor_2"], 2, CYCLE, layout)
    model = fit_ridge(raw.withColumn("window", scalers.transform_window(F.col("window"), scaler, ["sensor_2"])), 2, 1)
    path = _folder(spark, "detector")
    kept = Detector("forecast", 0.2, ["sensor_2"], scaler, model, 2, 1, "ridge-one-lag")
    stores.save_detector(spark, kept, path)
    found = stores.load_detector(spark, path)
    scaled = raw.withColumn("window", scalers.transform_window(F.col("window"), found.scaler, found.features))
    decided = decide(score(scaled, found), found.threshold, found.version)
    return decided.select(
        engine_name(F.col(UNIT)).alias("sensor_id"), CYCLE, rounded("anomaly_score").alias("anomaly_score"),
        "is_anomaly", "model_version",
    )


@query(
    with_(
        SUPPLIER_PANEL,
        """centre AS (SELECT count(*) AS n, avg(sensor_2) AS mx, avg(sensor_7 * 100) AS my FROM supplier_panel),
        spread AS (
          SELECT max(mx) AS mx, max(my) AS my, sum((sensor_2 - mx) * (sensor_2 - mx)) AS a,
            sum((sensor_2 - mx) * (sensor_7 * 100 - my)) AS b, sum((sensor_7 * 100 - my) * (sensor_7 * 100 - my)) AS c
          FROM supplier_panel, centre),
        axis AS (SELECT mx, my, 0.5 * atan2(2 * b, a - c) AS angle FROM spread)""",
        select="""SELECT unit_id, time_cycles, round(power((sensor_7 * 100 - my) * cos(angle)
          - (sensor_2 - mx) * sin(angle), 2) / 2, 5) + 0.0 AS score FROM supplier_panel, axis""",
    )
)
def plane_reconstruction(spark, sf_dir):
    """One component in the plane: the error is the distance to the main axis, which has a closed form."""
    rows = fixtures.supplier_panel(spark, sf_dir)[0].select(
        UNIT, CYCLE, F.array("sensor_2", F.col("sensor_7") * 100).alias("features")
    )
    rows = settle(rows)
    model = fit_reconstruction(rows, 2, latent=1)
    return rounded_all(reconstruction_error(rows, model).select(UNIT, CYCLE, "score"), 5)


@query(
    """WITH n AS (SELECT count(*) AS n_rows FROM embeddings)
    SELECT n_rows, CAST(50 AS BIGINT) AS n_trees, least(n_rows, 256) AS sample_size,
      CAST(50 AS BIGINT) * least(n_rows, 256) AS sampled, CAST(0 AS DOUBLE) AS lowest, CAST(1 AS DOUBLE) AS highest, true AS all_in_range,
      true AS depth_bounded, true AS more_splits_than_trees, true AS same_when_repeated,
      true AS far_row_scores_highest FROM n"""
)
def forest_invariants(spark, sf_dir):
    """What holds for every isolation forest, checked on one that is fitted on all vectors and a far one.

    A leaf's path is its depth plus the mean path of its rows, so the leaves of a tree tell
    the depth bound and, with their split rows, that every sampled row is in one leaf.
    """
    values = F.transform("embedding", lambda v: v.cast("double"))
    vectors = settle(read_table(spark, sf_dir, "embeddings").select("vec_id", values.alias("features")))
    forest, scored = fit_and_score(vectors, ["vec_id"], trees=50)
    again = forest.score(spark, F.col("features"))
    compared = vectors.select("vec_id", again.alias("again")).join(scored, "vec_id")
    far = vectors.limit(1).select(F.transform("features", lambda v: v + 1000.0).alias("features"))
    beyond = far.select(forest.score(spark, F.col("features")).alias("score"))
    nodes = spark.createDataFrame(forest.nodes)
    limit = math.ceil(math.log2(max(2, forest.sample_size)))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        rounded(F.min("score")).alias("lowest"),
        rounded(F.max("score")).alias("highest"),
        F.every(F.col("score").between(0, 1)).alias("all_in_range"),
    ).select(
        "n_rows",
        nodes.agg(F.count_distinct("tree")).scalar().alias("n_trees"),
        F.lit(forest.sample_size).cast("long").alias("sample_size"),
        nodes.agg(F.sum(F.when(F.col("feature") < 0, F.col("rows")))).scalar().alias("sampled"),
        "lowest",
        "highest",
        "all_in_range",
        nodes.agg(F.every(F.col("depth") <= limit)).scalar().alias("depth_bounded"),
        nodes.agg(F.count_if(F.col("feature") >= 0) > 50).scalar().alias("more_splits_than_trees"),
        compared.agg(F.max(F.abs(F.col("again") - F.col("score"))) < 1e-9).scalar().alias("same_when_repeated"),
        (beyond.scalar() >= 1.0).alias("far_row_scores_highest"),
    )


@query(
    with_(
        READINGS,
        """stored AS (
          SELECT sensor_id, ts, anomaly_score, least(1.0, abs(anomaly_score - 0.2) / 0.2) AS confidence, event_id
          FROM readings WHERE anomaly_score > 0.2),
        twice AS (SELECT * FROM stored UNION ALL (SELECT * FROM stored ORDER BY event_id LIMIT 1))""",
        select="""SELECT strftime(ts, '%Y-%m-%d') AS detected_date, count(*) AS n_events,
        round(sum(anomaly_score), 6) + 0.0 AS score_sum, round(min(confidence), 6) + 0.0 AS min_confidence,
        CAST(7 AS BIGINT) AS n_columns FROM twice GROUP BY 1""",
    )
)
def event_table(spark, sf_dir):
    """The event table from its definition: one event, then a batch, appended and read back by day."""
    table = f"events_{uuid.uuid4().hex}"
    for _ in range(2):  # the second definition finds the table
        stores.create_event_table(spark, table, _folder(spark, "event-table"))
    scored = fixtures.scored_readings(spark, sf_dir).select(
        "sensor_id", F.col("ts").alias("detected_at"), "anomaly_score", "event_id"
    )
    events = settle(decide(scored, fixtures.ALARM, "naive_forecast:local").filter("is_anomaly"))
    stores.append_events(events.orderBy("event_id").limit(1), table)
    stores.append_events(events, table)
    found = spark.table(table)
    own = len([c for c in found.columns if c != "detected_date"])
    return found.groupBy(F.col("detected_date").cast("string").alias("detected_date")).agg(
        F.count(F.lit(1)).alias("n_events"),
        rounded(F.sum("anomaly_score")).alias("score_sum"),
        rounded(F.min("confidence")).alias("min_confidence"),
        F.lit(own).cast("long").alias("n_columns"),
    )


@query(
    with_(
        SCORES,
        """decided AS (SELECT score, label, CAST(score > 0.2 AS INTEGER) AS pred FROM scores),
        cells AS (
          SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
            count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn
          FROM decided),
        by_score AS (
          SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS q
          FROM scores GROUP BY score),
        ranked AS (
          SELECT *, sum(p) OVER up AS p_upto, sum(q) OVER up AS q_upto, sum(p) OVER () AS pp, sum(q) OVER () AS qq
          FROM by_score WINDOW up AS (ORDER BY score ROWS UNBOUNDED PRECEDING)),
        auc AS (SELECT sum(p * (q_upto - q + q / 2.0)) / max(pp) / max(qq) AS auc FROM ranked)""",
        SWEEP_SQL,
        """ranges AS (
          SELECT label, min(score) AS lo, max(score) AS hi, count(*) AS n FROM scores GROUP BY label),
        bins AS (
          SELECT s.label, least(49, CAST(floor((score - lo) / ((hi - lo) / 50)) AS INTEGER)) AS bin, count(*) AS n_rows
          FROM scores s JOIN ranges r ON s.label = r.label GROUP BY ALL)""",
        select="""SELECT 'metrics' AS part, 'f1' AS name, CAST(0 AS DOUBLE) AS place,
          round(2.0 * tp / (2 * tp + fp + fn), 6) + 0.0 AS value FROM cells
        UNION ALL SELECT 'metrics', 'precision', 0, round(tp / (tp + fp), 6) + 0.0 FROM cells
        UNION ALL SELECT 'metrics', 'recall', 0, round(tp / (tp + fn), 6) + 0.0 FROM cells
        UNION ALL SELECT 'metrics', 'auc_roc', 0, round(auc, 6) + 0.0 FROM auc
        UNION ALL SELECT 'confusion', '1-1', 0, tp FROM cells UNION ALL SELECT 'confusion', '0-1', 0, fp FROM cells
        UNION ALL SELECT 'confusion', '1-0', 0, fn FROM cells UNION ALL SELECT 'confusion', '0-0', 0, tn FROM cells
        UNION ALL SELECT 'threshold_curve', 'f1', step, round(f1, 6) + 0.0 FROM sweep
        UNION ALL SELECT 'roc', 'fpr', round(score, 6) + 0.0, round((qq - q_upto + q) / qq, 6) + 0.0 FROM ranked
        UNION ALL SELECT 'roc', 'tpr', round(score, 6) + 0.0, round((pp - p_upto + p) / pp, 6) + 0.0 FROM ranked
        UNION ALL SELECT 'histogram', CAST(label AS VARCHAR), bin, n_rows FROM bins""",
    )
)
def evaluation_bundle(spark, sf_dir):
    """All evaluation tables of one scored set, stacked."""
    scored = settle(fixtures.score_set(spark, sf_dir).select("score", "label"))
    tables = metrics.evaluate(scored, 0.2)

    def entries(df: DataFrame, part: str, place, **values) -> DataFrame:
        listed = F.array(*[F.struct(F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in values.items()])
        at = place.cast("double").alias("place")
        return df.select(F.lit(part).alias("part"), at, F.inline(listed)).select("part", "name", "place", "value")

    zero, col = F.lit(0), F.col
    headline = {c: col(c) for c in ("f1", "precision", "recall", "auc_roc")}
    cells = tables["confusion"].select(
        F.lit("confusion").alias("part"),
        F.concat_ws("-", "label", "pred").alias("name"),
        zero.cast("double").alias("place"),
        col("n_rows").cast("double").alias("value"),
    )
    bars = tables["histogram"].select(
        F.lit("histogram").alias("part"),
        col("label").cast("string").alias("name"),
        col("bin").cast("double").alias("place"),
        col("n_rows").cast("double").alias("value"),
    )
    stacked = (
        entries(tables["metrics"], "metrics", zero, **headline)
        .unionByName(cells)
        .unionByName(entries(tables["threshold_curve"], "threshold_curve", col("step"), f1=col("f1")))
        .unionByName(entries(tables["roc"], "roc", col("threshold"), fpr=col("fpr"), tpr=col("tpr")))
        .unionByName(bars)
    )
    return rounded_all(stacked)
