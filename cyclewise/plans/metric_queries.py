"""Registered queries: metrics, thresholds, model tables, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.constants import CONTAMINATION_GRID
from cyclewise.functions.contracts import REASONS, result_reasons
from cyclewise.operators import drift, metrics
from cyclewise.operators.scoring import anomalies_only, decide
from cyclewise.plans import fixtures
from cyclewise.plans.registry import DRIFT_PAIR, SCORES, query, rounded, rounded_all, with_
from cyclewise.sources.stores import latest_runs

CUT = 0.15


def _decided(spark, sf_dir):
    return fixtures.score_set(spark, sf_dir).withColumn("pred", (F.col("score") > CUT).cast("int"))


_COUNTS = """
counts AS (
  SELECT count(*) FILTER (WHERE label = 0 AND score <= 0.15) AS tn,
         count(*) FILTER (WHERE label = 0 AND score > 0.15) AS fp,
         count(*) FILTER (WHERE label = 1 AND score <= 0.15) AS fn,
         count(*) FILTER (WHERE label = 1 AND score > 0.15) AS tp FROM scores)
"""

_RANKED = """
ranked AS (
  SELECT score, p, n, sum(p) OVER up AS p_upto, sum(n) OVER up AS n_upto,
         sum(p) OVER () AS p_total, sum(n) OVER () AS n_total
  FROM (SELECT score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
               CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n FROM scores GROUP BY score) c
  WINDOW up AS (ORDER BY score ROWS UNBOUNDED PRECEDING)),
area AS (SELECT sum(p * (n_upto - n + n / 2)) / any_value(p_total) / any_value(n_total) AS auc_roc
         FROM ranked)
"""

SWEEP_SQL = """
steps AS (SELECT CAST(i AS INTEGER) AS step, 0.01::DOUBLE + i * (0.99::DOUBLE / 99) AS threshold
          FROM range(100) t(i)),
swept AS (SELECT step, threshold, count(*) FILTER (WHERE label = 1 AND score > threshold) AS tp,
                 count(*) FILTER (WHERE label = 0 AND score > threshold) AS fp,
                 count(*) FILTER (WHERE label = 1 AND score <= threshold) AS fn, count(*) AS n
          FROM scores, steps GROUP BY step, threshold),
sweep AS (SELECT *, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
                 coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
                 coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM swept)
"""


@query(
    with_(
        SCORES,
        _COUNTS,
        select="""SELECT 0 AS label, 0 AS pred, tn AS n_rows FROM counts
        UNION ALL SELECT 0, 1, fp FROM counts UNION ALL SELECT 1, 0, fn FROM counts
        UNION ALL SELECT 1, 1, tp FROM counts""",
    )
)
def confusion(spark, sf_dir):
    return metrics.confusion_matrix(_decided(spark, sf_dir))


@query(
    with_(
        SCORES,
        _COUNTS,
        select="""SELECT round(tp / (tp + fp), 6) + 0.0 AS precision,
        round(tp / (tp + fn), 6) + 0.0 AS recall,
        round(2.0 * tp / (2 * tp + fp + fn), 6) + 0.0 AS f1 FROM counts""",
    )
)
def prf(spark, sf_dir):
    return rounded_all(metrics.precision_recall_f1(_decided(spark, sf_dir)))


@query(with_(SCORES, _RANKED, select="SELECT round(auc_roc, 6) + 0.0 AS auc_roc FROM area"))
def auc(spark, sf_dir):
    return rounded_all(metrics.auc_roc(fixtures.score_set(spark, sf_dir)))


@query(
    with_(
        SCORES,
        _RANKED,
        select="""SELECT round(score, 9) + 0.0 AS threshold,
        round((n_total - n_upto + n) / n_total, 6) + 0.0 AS fpr,
        round((p_total - p_upto + p) / p_total, 6) + 0.0 AS tpr FROM ranked""",
    )
)
def roc_points(spark, sf_dir):
    return rounded_all(metrics.roc_points(fixtures.score_set(spark, sf_dir)), threshold=9)


@query(
    with_(
        SCORES,
        _RANKED,
        SWEEP_SQL,
        select="""SELECT round(threshold, 6) + 0.0 AS threshold, round(f1, 6) + 0.0 AS f1,
        round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall,
        round((SELECT auc_roc FROM area), 6) + 0.0 AS auc_roc FROM sweep
        WHERE tp + fp > 0 AND tp + fp < n ORDER BY f1 DESC, step LIMIT 1""",
    )
)
def threshold_search(spark, sf_dir):
    return rounded_all(metrics.threshold_search(fixtures.score_set(spark, sf_dir)))


@query(
    with_(
        SCORES,
        SWEEP_SQL,
        select="""SELECT step, round(threshold, 6) + 0.0 AS threshold, round(f1, 6) + 0.0 AS f1,
        round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall,
        step = first_value(step) OVER (ORDER BY f1 DESC, step) AS is_best FROM sweep""",
    )
)
def threshold_curve(spark, sf_dir):
    return rounded_all(metrics.threshold_curve(fixtures.score_set(spark, sf_dir)))


@query(
    with_(
        SCORES,
        "spans AS (SELECT label, min(score) AS lo, max(score) AS hi, count(*) AS n FROM scores "
        "GROUP BY label)",
        select="""SELECT s.label, CAST(least(greatest(floor((score - lo) / (hi - lo) * 50), 0), 49)
          AS INTEGER) AS bin, round(any_value(lo + least(greatest(floor((score - lo) / (hi - lo)
          * 50), 0), 49) * ((hi - lo) / 50)), 6) + 0.0 AS bin_start, count(*) AS n_rows,
        round(count(*) / any_value(n * ((hi - lo) / 50)), 6) + 0.0 AS density
        FROM scores s JOIN spans p ON s.label = p.label GROUP BY 1, 2""",
    )
)
def score_histogram(spark, sf_dir):
    return rounded_all(metrics.score_histogram(fixtures.score_set(spark, sf_dir)))


@query(
    with_(
        SCORES,
        select="""SELECT event_id, round((score - (SELECT min(score) FROM scores)) /
        ((SELECT max(score) FROM scores) - (SELECT min(score) FROM scores)), 6) + 0.0 AS score,
        label FROM scores""",
    )
)
def score_normalise(spark, sf_dir):
    return rounded_all(metrics.score_normalised(fixtures.score_set(spark, sf_dir)))


_GRID = ", ".join(f"({i}, {c}::DOUBLE)" for i, c in enumerate(CONTAMINATION_GRID))
_CUTS = f"""
grid(position, contamination) AS (VALUES {_GRID}),
cuts AS (SELECT CAST(position AS INTEGER) AS position, contamination, CASE position """ + " ".join(
    f"WHEN {i} THEN (SELECT quantile_cont(score, 1 - {c}::DOUBLE) FROM scores)"
    for i, c in enumerate(CONTAMINATION_GRID)
) + " END AS cut FROM grid)"


@query(
    with_(
        SCORES,
        _CUTS,
        select="""SELECT round(cut, 6) + 0.0 AS cut,
        count(*) FILTER (WHERE score > cut) AS n_flagged, count(*) AS n_rows
        FROM scores, cuts WHERE position = 2 GROUP BY cut""",
    )
)
def contamination_cut(spark, sf_dir):
    """The exact cut for the default contamination, and what it flags."""
    scores = fixtures.score_set(spark, sf_dir)
    cut = metrics.contamination_cuts(scores, [0.05])[0]
    return scores.agg(
        F.count_if(F.col("score") > cut).alias("n_flagged"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("cut", rounded(F.lit(cut)))


_GRID_F1 = """
graded AS (SELECT position, contamination, cut,
  2.0 * count(*) FILTER (WHERE label = 1 AND score > cut) /
  (count(*) FILTER (WHERE score > cut) + count(*) FILTER (WHERE label = 1)) AS f1
  FROM scores, cuts GROUP BY position, contamination, cut)
"""


@query(
    with_(
        SCORES,
        _CUTS,
        _GRID_F1,
        select="""SELECT position, contamination, round(cut, 6) + 0.0 AS cut,
        round(f1, 6) + 0.0 AS f1, position = first_value(position) OVER (ORDER BY f1 DESC,
        position) AS is_best FROM graded""",
    )
)
def contamination_grid(spark, sf_dir):
    scores = fixtures.score_set(spark, sf_dir)
    cuts = metrics.contamination_cuts(scores, CONTAMINATION_GRID)
    grid = metrics.contamination_grid(scores, CONTAMINATION_GRID, cuts)
    best = metrics.best_of_grid(grid).select("position").scalar()
    return rounded_all(grid.withColumn("is_best", F.col("position") == best))


_RUNS = """
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS model_type, ts AS start_time,
         CASE WHEN value > 60 THEN 'Production' ELSE 'Staging' END AS stage, value / 600 AS f1,
         value / 1200 AS precision,
         CASE WHEN event_type <> 'view' THEN value / 2400 END AS auc FROM events),
latest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY model_type
             ORDER BY start_time DESC, run_id DESC) = 1)
"""


@query(
    with_(
        _RUNS,
        select="""SELECT model_type, run_id, stage, CAST(epoch_us(start_time) AS BIGINT)
        AS start_us FROM latest""",
    )
)
def latest_run(spark, sf_dir):
    runs = fixtures.runs(spark, sf_dir)
    return latest_runs(runs).select(
        "model_type", "run_id", "stage", F.unix_micros("start_time").alias("start_us")
    )


@query(
    with_(
        _RUNS.replace("FROM events),", "FROM events WHERE value > 60),"),
        select="""SELECT model_type, run_id FROM latest""",
    )
)
def latest_production_version(spark, sf_dir):
    runs = fixtures.runs(spark, sf_dir).filter("stage = 'Production'")
    return latest_runs(runs).select("model_type", "run_id")


_MODELS = fixtures.MODEL_TYPES


def _wide(metric, column):
    values = ", ".join(
        f"round(coalesce(max({column}) FILTER (WHERE model_type = '{m}'), 0.0), 6) + 0.0 AS {m}"
        for m in _MODELS
    )
    return f"SELECT '{metric}' AS metric, {values} FROM latest"


@query(
    with_(
        _RUNS,
        select=" UNION ALL ".join(
            _wide(m, c)
            for m, c in (
                ("test_f1", "f1"),
                ("test_precision", "precision"),
                ("test_recall", "NULL::DOUBLE"),
                ("test_auc_roc", "auc"),
            )
        ),
    )
)
def model_comparison(spark, sf_dir):
    runs = latest_runs(fixtures.runs(spark, sf_dir))
    return rounded_all(metrics.model_comparison(runs, _MODELS))


_DECIDED = """
decided AS (SELECT event_id, score AS anomaly_score, score > 0.15 AS is_anomaly,
              least(1.0, abs(score - 0.15) / 0.15) AS confidence,
              'naive_forecast:local' AS model_version FROM scores)
"""


def _decisions(spark, sf_dir):
    scored = fixtures.score_set(spark, sf_dir).withColumnRenamed("score", "anomaly_score")
    return decide(scored.drop("label"), CUT, "naive_forecast:local")


@query(
    with_(
        SCORES,
        _DECIDED,
        select="""SELECT event_id, round(anomaly_score, 6) + 0.0 AS anomaly_score, is_anomaly,
        round(confidence, 6) + 0.0 AS confidence, model_version FROM decided""",
    )
)
def decision_confidence(spark, sf_dir):
    return rounded_all(_decisions(spark, sf_dir))


@query(
    with_(
        SCORES,
        _DECIDED,
        select="""SELECT event_id, round(anomaly_score, 6) + 0.0 AS anomaly_score FROM decided
        WHERE is_anomaly""",
    )
)
def events_out(spark, sf_dir):
    return rounded_all(
        anomalies_only(_decisions(spark, sf_dir)).select("event_id", "anomaly_score")
    )


@query(
    with_(
        SCORES,
        _DECIDED,
        select="""SELECT count(*) AS n_rows, count(*) FILTER (WHERE anomaly_score < 0 OR
        confidence < 0 OR confidence > 1) AS n_broken FROM decided""",
    )
)
def result_contract(spark, sf_dir):
    checked = _decisions(spark, sf_dir).withColumn(REASONS, result_reasons())
    return checked.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size(REASONS) > 0).alias("n_broken")
    )


# Drift


@query(
    with_(
        DRIFT_PAIR,
        select="""SELECT feature, round(statistic, 6) + 0.0 AS statistic, n_reference, n_current,
        round(p_value, 6) + 0.0 AS p_value FROM tested""",
    )
)
def ks_drift(spark, sf_dir):
    return rounded_all(drift.ks_test(*fixtures.drift_pair(spark, sf_dir)))


@query(
    with_(
        DRIFT_PAIR,
        select="""SELECT count(*) FILTER (WHERE p_value < 0.05) > 0.4 AS is_drifted,
        4 AS num_features, count(*) FILTER (WHERE p_value < 0.05) AS num_features_drifted,
        string_agg(feature, ',' ORDER BY feature) FILTER (WHERE p_value < 0.05)
          AS drifted_features,
        round(min(p_value) FILTER (WHERE feature = 'sensor_3'), 6) + 0.0 AS score_sensor_3
        FROM tested""",
    )
)
def drift_decision(spark, sf_dir):
    found = drift.detect_drift(*fixtures.drift_pair(spark, sf_dir))
    return rounded_all(
        found.withColumn("score_sensor_3", F.element_at("drift_scores", "sensor_3"))
        .withColumn("drifted_features", F.concat_ws(",", "drifted_features"))
        .drop("drift_scores")
    )


_AREA = """
spreads AS (SELECT feature, stddev_pop(v) AS spread FROM long WHERE side = 0 GROUP BY feature),
areas AS (SELECT e.feature, sum(abs(ref_cdf - cur_cdf) * (next_v - v)) AS distance,
                 sum(abs(ref_cdf - cur_cdf) * (next_v - v)) / greatest(any_value(spread), 0.001)
                   AS normed_distance FROM ecdf e JOIN spreads s ON e.feature = s.feature
          GROUP BY e.feature)
"""


@query(
    with_(
        DRIFT_PAIR,
        _AREA,
        select="""SELECT feature, round(distance, 4) + 0.0 AS distance,
        round(normed_distance, 6) + 0.0 AS normed_distance FROM areas""",
    )
)
def wasserstein(spark, sf_dir):
    found = drift.wasserstein(*fixtures.drift_pair(spark, sf_dir))
    return rounded_all(found.drop("n_reference", "n_current"), distance=4)


@query(
    with_(
        DRIFT_PAIR,
        _AREA,
        """graded AS (SELECT t.feature, CASE WHEN n_reference <= 1000 THEN p_value < 0.05
             ELSE normed_distance >= 0.1 END AS drifted
             FROM tested t JOIN areas a ON t.feature = a.feature)""",
        select="""SELECT count(*) FILTER (WHERE drifted) >= 2 AS is_drifted,
        count(*) FILTER (WHERE drifted) AS num_features_drifted,
        string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drifted) AS drifted_features
        FROM graded""",
    )
)
def preset_drift(spark, sf_dir):
    found = drift.preset_report(*fixtures.drift_pair(spark, sf_dir))
    return found.select(
        "is_drifted",
        "num_features_drifted",
        F.concat_ws(",", "drifted_features").alias("drifted_features"),
    )


@query(
    with_(
        DRIFT_PAIR,
        select="""SELECT side, count(*) AS n_rows, round(sum(sensor_2), 2) + 0.0 AS sensor_2,
        round(sum(sensor_7), 2) + 0.0 AS sensor_7 FROM stacked GROUP BY side""",
    )
)
def drift_stack(spark, sf_dir):
    reference, current = fixtures.drift_pair(spark, sf_dir)
    stacked = drift.stack_sides(reference, current, drift.common_columns(reference, current))
    return stacked.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"),
        rounded(F.sum("sensor_2"), 2).alias("sensor_2"),
        rounded(F.sum("sensor_7"), 2).alias("sensor_7"),
    )
