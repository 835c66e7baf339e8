from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.constants import CONTAMINATION_GRID
from cyclewise.functions.numeric import linspace, thresholds_below
from cyclewise.operators import metrics
from cyclewise.operators.prefix import exact_quantiles


def scored(spark, scores, labels):
    rows = [(float(s), int(y)) for s, y in zip(scores, labels)]
    return spark.createDataFrame(rows, "score double, label int")


@pytest.fixture(scope="module")
def sample(spark):
    """A third of the rows share one score."""
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 600)
    scores = np.round(np.clip(rng.normal(0.4 + 0.15 * labels, 0.2), 0, 1.2), 2)
    scores[::3] = 0.5
    return scored(spark, scores, labels).persist(), scores, labels


def f1_parts(scores, labels, t):
    pred = scores > t
    tp = int((pred & (labels == 1)).sum())
    fp = int((pred & (labels == 0)).sum())
    fn = int((~pred & (labels == 1)).sum())
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
    return f1, precision, recall, tp + fp


def auc_by_pairs(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()
    return wins / len(pos) / len(neg)


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_auc_with_ties(sample, buckets):
    df, scores, labels = sample
    found = metrics.auc_roc(df, buckets).first()[0]
    assert found == pytest.approx(auc_by_pairs(scores, labels))


def test_auc_needs_two_classes(spark):
    assert metrics.auc_roc(scored(spark, [0.1, 0.2], [0, 0])).first()[0] is None


def test_perfect_separation(spark):
    df = scored(spark, [0.1, 0.2, 0.3, 0.8, 0.9], [0, 0, 0, 1, 1])
    row = metrics.threshold_search(df).first()
    assert row["f1"] == 1.0 and row["auc_roc"] == 1.0
    assert 0.3 <= row["threshold"] < 0.8


def test_one_class_has_no_auc(spark):
    row = metrics.threshold_search(scored(spark, [0.1, 0.5, 0.9], [0, 0, 0])).first()
    assert row["auc_roc"] is None


def test_no_usable_threshold(spark):
    row = metrics.threshold_search(scored(spark, [5.0, 6.0], [0, 1])).first()
    assert row["threshold"] == 0.01 and row["f1"] is None and row["precision"] is None


def test_search_against_loop(sample):
    df, scores, labels = sample
    best = (-1.0, 0.01, 0.0, 0.0)
    for t in np.linspace(0.01, 1.0, 100):
        f1, p, r, flagged = f1_parts(scores, labels, t)
        if 0 < flagged < len(scores) and f1 > best[0]:
            best = (f1, t, p, r)
    row = metrics.threshold_search(df).first()
    assert (row["f1"], row["threshold"], row["precision"], row["recall"]) == pytest.approx(best)


def test_curve_against_loop(sample):
    df, scores, labels = sample
    curve = metrics.threshold_curve(df, 0.0, 1.5, 31).orderBy("step").collect()
    grid = np.linspace(0.0, 1.5, 31)
    wanted = [f1_parts(scores, labels, t) for t in grid]
    assert [r["f1"] for r in curve] == pytest.approx([w[0] for w in wanted])
    assert [r["recall"] for r in curve] == pytest.approx([w[2] for w in wanted])
    assert [r["step"] for r in curve if r["is_best"]] == [int(np.argmax([w[0] for w in wanted]))]


def test_flagged_rows_fall_with_the_threshold(sample):
    df, _, _ = sample
    flagged = [r["n_flagged"] for r in metrics.threshold_sweep(df).orderBy("step").collect()]
    assert flagged == sorted(flagged, reverse=True)


def test_thresholds_below_on_the_thresholds(spark):
    df = spark.range(1).select(F.explode(linspace(0.01, 1.0, 100)).alias("t"))
    found = df.select("t", thresholds_below(F.col("t"), 0.01, 1.0, 100).alias("k")).collect()
    assert [r["k"] for r in found] == list(range(100))


def test_roc_points(sample):
    df, scores, labels = sample
    points = metrics.roc_points(df, 5).orderBy(F.desc("threshold")).collect()
    assert len(points) == len(set(scores))
    for r in points:
        at = scores >= r["threshold"]
        assert r["tpr"] == pytest.approx((at & (labels == 1)).sum() / (labels == 1).sum())
        assert r["fpr"] == pytest.approx((at & (labels == 0)).sum() / (labels == 0).sum())
    assert points[-1]["tpr"] == points[-1]["fpr"] == 1.0


def test_confusion_has_empty_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 1)], "label int, pred int")
    cells = {(r["label"], r["pred"]): r["n_rows"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, pred int")
    assert tuple(metrics.precision_recall_f1(df).first()) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("buckets", [2, 16])
def test_exact_quantiles(sample, buckets):
    df, scores, _ = sample
    shares = [0.0, 0.31, 0.5, 0.85, 0.99, 1.0]
    assert exact_quantiles(df, "score", shares, buckets) == pytest.approx(
        list(np.quantile(scores, shares))
    )


def test_contamination(sample):
    df, scores, labels = sample
    cuts = metrics.contamination_cuts(df, CONTAMINATION_GRID)
    assert cuts == pytest.approx([np.quantile(scores, 1 - c) for c in CONTAMINATION_GRID])
    grid = metrics.contamination_grid(df, CONTAMINATION_GRID, cuts)
    f1 = {r["position"]: r["f1"] for r in grid.collect()}
    wanted = [f1_parts(scores, labels, c)[0] for c in cuts]
    assert [f1[i] for i in range(len(cuts))] == pytest.approx(wanted)
    assert metrics.best_of_grid(grid).first()["position"] == int(np.argmax(wanted))


def test_best_of_grid_takes_the_first(spark):
    grid = spark.createDataFrame([(1, 0.5), (0, 0.5), (2, 0.1)], "position int, f1 double")
    assert metrics.best_of_grid(grid).first()["position"] == 0


def test_histogram(sample):
    df, scores, labels = sample
    rows = metrics.score_histogram(df, 10).collect()
    for y in (0, 1):
        counts, _ = np.histogram(scores[labels == y], bins=10)
        mine = {r["bin"]: r for r in rows if r["label"] == y}
        assert sum(r["n_rows"] for r in mine.values()) == counts.sum()
        width = np.ptp(scores[labels == y]) / 10
        assert sum(r["density"] * width for r in mine.values()) == pytest.approx(1.0)


def test_histogram_of_one_value(spark):
    row = metrics.score_histogram(scored(spark, [0.5, 0.5], [0, 0]), 10).first()
    assert row["n_rows"] == 2 and row["bin"] == 5 and row["density"] == pytest.approx(10.0)


def test_normalised_scores(spark):
    df = scored(spark, [1.0, 2.0, 3.0], [0, 0, 1])
    assert [r["score"] for r in metrics.score_normalised(df).collect()] == [0.0, 0.5, 1.0]
    assert [r["score"] for r in metrics.score_normalised(df, 0.0, 2.0).collect()] == [0.5, 1.0, 1.5]
    flat = scored(spark, [2.0, 2.0], [0, 0])
    assert [r["score"] for r in metrics.score_normalised(flat).collect()] == [0.0, 0.0]


def test_model_comparison(spark):
    runs = spark.createDataFrame(
        [("a", {"test_f1": 0.5}), ("b", {"test_f1": 0.25, "test_recall": 1.0})],
        "model_type string, metrics map<string,double>",
    )
    table = {r["metric"]: (r["a"], r["b"]) for r in metrics.model_comparison(runs, ["a", "b"]).collect()}
    assert table["test_f1"] == (0.5, 0.25)
    assert table["test_recall"] == (0.0, 1.0)
    open_table = metrics.model_comparison(runs, ["a", "b"], missing=None)
    assert {r["metric"]: r["a"] for r in open_table.collect()}["test_recall"] is None


def test_evaluate_bundle(sample):
    df, scores, labels = sample
    tables = metrics.evaluate(df, 0.5)
    assert set(tables) == {"metrics", "confusion", "threshold_curve", "roc", "histogram"}
    row = tables["metrics"].first()
    assert (row["f1"], row["precision"], row["recall"]) == pytest.approx(
        f1_parts(scores, labels, 0.5)[:3]
    )
    assert row["auc_roc"] == pytest.approx(auc_by_pairs(scores, labels))
