from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, UNIT
from cyclewise.operators import features, scalers, scoring
from cyclewise.operators.models import forest as forests
from cyclewise.operators.models.forecast import fit_ridge, naive_error
from cyclewise.operators.models.reconstruction import fit_reconstruction, reconstruction_error
from cyclewise.operators.scoring import Detector, detect, detect_requests
from cyclewise.plans import training
from cyclewise.sources import stores


@pytest.fixture(scope="module")
def points(spark):
    """A cloud with three outliers."""
    rng = np.random.default_rng(1)
    cloud = rng.normal(0, 1, (600, 3))
    cloud[:3] += 12
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(cloud)]
    return spark.createDataFrame(rows, "id long, features array<double>").persist()


@pytest.fixture(scope="module")
def forest(points):
    return forests.fit_and_score(points, ["id"], trees=60, sample_size=64)


def test_forest_finds_outliers(forest):
    scores = {r["id"]: r["score"] for r in forest[1].collect()}
    assert len(scores) == 600
    assert min(scores.values()) == 0.0 and max(scores.values()) == 1.0
    assert set(sorted(scores, key=scores.get)[-3:]) == {0, 1, 2}


def test_forest_is_reproducible(points, forest):
    again = forests.fit_nodes(points.repartition(3), ["id"], 60, 64).toPandas()
    again = again.sort_values(["tree", "node"], ignore_index=True)
    assert again.equals(forest[0].nodes)


def test_tree_shape(forest):
    nodes = forest[0].nodes
    assert nodes["tree"].nunique() == 60
    assert nodes.groupby("tree").size().max() <= 2 * 64 - 1
    assert nodes.loc[nodes["feature"] < 0, "path"].max() <= 6 + forests.average_path(64)


def test_trees_draw_the_sample_size(points):
    drawn = forests._tree_samples(points, ["id"], 20, 64, 7)
    sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert len(sizes) == 20 and set(sizes) == {64}
    assert drawn.select("tree", "id").distinct().count() == 20 * 64


def test_trees_draw_from_all_rows(spark):
    """The trees together see more rows than any pool of 64 samples holds."""
    many = spark.range(40_000).withColumn("features", F.array(F.col("id").cast("double")))
    drawn = forests._tree_samples(many, ["id"], 200, 256, 7).select("tree", "id").persist()
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {256}
    wanted = 40_000 * (1 - (1 - 256 / 40_000) ** 200)
    assert drawn.distinct().count() == 200 * 256
    assert drawn.select("id").distinct().count() == pytest.approx(wanted, rel=0.03)
    assert wanted > 64 * 256
    for part in ("id < 20000", "tree < 100 AND id < 20000"):
        share = 1.0 if "tree" not in part else 0.5
        assert drawn.filter(part).count() == pytest.approx(share * 200 * 128, rel=0.05)
    drawn.unpersist()


def test_path_length_against_walk(spark, points, forest):
    model = forest[0]
    by_tree = {t: g.set_index("node") for t, g in model.nodes.groupby("tree")}
    rows = points.limit(5).collect()
    raw = points.select("id", model.raw_score(spark, F.col("features")).alias("s"))
    found = {r["id"]: r["s"] for r in raw.collect()}
    for r in rows:
        total = 0.0
        for nodes in by_tree.values():
            at = 0
            while nodes.at[at, "feature"] >= 0:
                n = nodes.loc[at]
                at = int(n["left"] if r["features"][int(n["feature"])] <= n["split"] else n["right"])
            total += nodes.at[at, "path"]
        wanted = 2 ** (-total / len(by_tree) / forests.average_path(64))
        assert found[r["id"]] == pytest.approx(wanted)


def test_constant_rows(spark):
    df = spark.range(50).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("features"))
    _, scored = forests.fit_and_score(df, ["id"], trees=5, sample_size=16)
    assert {r["score"] for r in scored.collect()} == {0.0}


def test_average_path():
    assert [forests.average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert forests.average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_reconstruction_against_svd(points):
    model = fit_reconstruction(points, 3, latent=2)
    rows = reconstruction_error(points, model).orderBy("id").collect()
    x = np.array([r["features"] for r in rows])
    centred = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    back = centred @ vt[:2].T @ vt[:2]
    assert [r["score"] for r in rows] == pytest.approx(list(((centred - back) ** 2).mean(axis=1)), abs=1e-9)


def test_reconstruction_of_ten_thousand_dimensions(spark):
    """Rows of rank 3 plus small noise: the error is what the noise leaves, whatever the width."""
    d, n = 10_000, 60
    rng = np.random.default_rng(8)
    axes, seeds = rng.normal(size=(3, d)), rng.normal(size=(n, 3)) * [9.0, 5.0, 3.0]
    x = seeds @ axes + 4.0 + rng.normal(size=(n, d)) * 0.01
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, features array<double>")
    model = fit_reconstruction(rows.repartition(4), d, latent=3)
    assert model.components.shape == (d, 3)
    assert np.allclose(model.components.T @ model.components, np.eye(3), atol=1e-9)
    centred = x - x.mean(axis=0)
    vt = np.linalg.svd(centred, full_matrices=False)[2][:3]
    wanted = ((centred - centred @ vt.T @ vt) ** 2).mean(axis=1)
    found = {r["id"]: r["score"] for r in reconstruction_error(rows, model).select("id", "score").collect()}
    assert [found[i] for i in range(n)] == pytest.approx(list(wanted), rel=1e-3)
    assert max(found.values()) < 2e-4


def test_range_finder_close_to_svd_beyond_its_columns(spark):
    """A slowly falling spectrum in 120 dimensions, of which 8 + 32 are looked at."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 120)) * (0.9 ** np.arange(120))
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "features array<double>")
    found = reconstruction_error(rows, fit_reconstruction(rows, 120, latent=8)).agg(F.avg("score")).first()[0]
    centred = x - x.mean(axis=0)
    best = (np.linalg.svd(centred, compute_uv=False)[8:] ** 2).sum() / x.size
    assert best <= found <= best * 1.01


def test_reconstruction_without_rows(points):
    with pytest.raises(ValueError, match="no rows"):
        fit_reconstruction(points.limit(0), 3)


def test_stacked_trees_equal_single_walks():
    rng = np.random.default_rng(1)
    parts = []
    for tree in range(6):
        sample = pd.DataFrame({"tree": tree, "place": range(30), "features": rng.normal(size=(30, 4)).tolist()})
        parts.append(forests._grow(sample if tree else sample.head(1), 3))
    nodes = pd.concat(parts, ignore_index=True).sample(frac=1.0, random_state=2)
    stacked = forests.NodeArrays.of(nodes)
    stacked.BLOCK = 50
    x = rng.normal(size=(101, 4))
    wanted = []
    for row in x:
        total = 0.0
        for _, table in nodes.groupby("tree"):
            table, at = table.set_index("node"), 0
            while table.loc[at, "feature"] >= 0:
                n = table.loc[at]
                at = int(n["left"] if row[int(n["feature"])] <= n["split"] else n["right"])
            total += table.loc[at, "path"]
        wanted.append(total / 6)
    assert stacked.mean_path(x) == pytest.approx(wanted)
    assert stacked.mean_path(x[:0]).shape == (0,)


def test_ridge_against_least_squares(spark, panel):
    built = features.sliding_windows(panel, ["sensor_2", "sensor_3"], 12)
    model = fit_ridge(built, 12, 4, ridge=1e-3)
    rows = built.select("window", model.error(spark, F.col("window")).alias("e")).collect()
    w = np.array([r["window"] for r in rows])
    series = w.transpose(0, 2, 1).reshape(-1, 12)
    x = np.hstack([np.ones((len(series), 1)), series[:, :8]])
    penalty = np.diag([0.0] + [1e-3 * len(series)] * 8)
    weights = np.linalg.solve(x.T @ x + penalty, x.T @ series[:, 8:])
    assert np.allclose(model.weights, weights, rtol=1e-6)
    errors = ((series[:, 8:] - x @ weights) ** 2).mean(axis=1).reshape(len(rows), 2).mean(axis=1)
    assert [r["e"] for r in rows] == pytest.approx(list(errors))
    with pytest.raises(ValueError, match="horizon"):
        fit_ridge(built, 12, 12)


def test_naive_error(spark):
    df = spark.sql("select array(array(1D), array(2D), array(4D), array(1D)) window")
    assert df.select(naive_error(F.col("window"), 4, 2)).first()[0] == pytest.approx((4 + 1) / 2)


def test_decisions(spark):
    df = spark.createDataFrame([(0.5,), (0.8,), (0.2,), (9.0,)], "anomaly_score double")
    rows = scoring.decide(df, 0.5, "v").collect()
    assert [r["is_anomaly"] for r in rows] == [False, True, False, True]
    assert [r["confidence"] for r in rows] == pytest.approx([0.0, 0.6, 0.6, 1.0])
    zero = scoring.decide(df, 0.0, "v").collect()
    assert {r["confidence"] for r in zero} == {0.5}


def test_names_and_versions():
    assert Detector("lstm_ae", 1.0, []).version == "reconstruction:local"
    assert Detector("patchtst", 1.0, [], run_id="abcdef1234").version == "forecast:abcdef12"
    with pytest.raises(ValueError, match="Unknown model type"):
        Detector("nope", 1.0, [])


@pytest.fixture(scope="module")
def prepared(panel):
    more = panel
    for k in range(1, 6):
        shifted = panel.withColumn(UNIT, F.col(UNIT) + 2 * k)
        more = more.unionByName(shifted.withColumn("sensor_2", F.col("sensor_2") + k))
    narrow = more.select(UNIT, CYCLE, "sensor_2", "sensor_3", "rul", "is_anomaly")
    return training.prepare(narrow, 20)


def test_prepared_splits(prepared):
    units = {k: {r[0] for r in v.select(UNIT).distinct().collect()} for k, v in ((p, prepared.windows(p)) for p in ("train", "val", "test"))}
    assert {k: len(v) for k, v in units.items()} == {"train": 7, "val": 2, "test": 3}
    assert len(prepared.features) == 2 + 2 * 3 * 2
    flat = prepared.windows("train").select(F.explode(F.flatten("window")).alias("v"))
    low, high = flat.agg(F.min("v"), F.max("v")).first()
    assert low >= -1e-9 and high <= 1 + 1e-9


@pytest.mark.parametrize("name", ["isolation_forest", "lstm_ae", "patchtst", "naive_forecast"])
def test_train_store_load_detect(spark, prepared, tmp_path, name):
    options = {"trees": 20} if name == "isolation_forest" else {}
    models, runs = f"{tmp_path}/models", f"{tmp_path}/runs"
    detector, reported = training.train_and_select(prepared, name, models, runs, **options)
    assert {"test_f1", "test_precision", "test_recall", "threshold"} <= set(reported)
    run = stores.read_runs(spark, runs).first()
    assert run["run_id"] == detector.run_id and run["metrics"]["threshold"] == detector.threshold
    assert stores.latest_version(stores.read_runs(spark, runs), detector.model_type, "Production") == detector.run_id
    with pytest.raises(ValueError, match="no run of"):
        stores.latest_version(stores.read_runs(spark, runs), "other", "Production")
    loaded = stores.load_detector(spark, f"{models}/{detector.run_id}")
    raw = prepared.windows("test", detector.features).select(UNIT, CYCLE, "window")
    a = {(r[0], r[1]): r for r in detect(raw, detector).collect()}
    b = {(r[0], r[1]): r for r in detect(raw, loaded).collect()}
    assert len(a) == 3 * 31 and a.keys() == b.keys()
    for k in a:
        assert a[k]["anomaly_score"] == pytest.approx(b[k]["anomaly_score"])
        assert a[k]["model_version"] == f"{detector.model_type}:{detector.run_id[:8]}"
        assert 0 <= a[k]["confidence"] <= 1


def test_requests_with_wrong_shape_are_quarantined(spark):
    detector = Detector("naive_forecast", 0.1, ["a"], None, None, 3, 1)
    rows = [("e1", [[1.0], [2.0], [3.0]]), ("e2", [[1.0], [2.0]]), ("e3", [[1.0], [2.0], [float("nan")]])]
    df = spark.createDataFrame(rows, "sensor_id string, window array<array<double>>")
    good, bad = detect_requests(df.withColumn("timestamp", F.current_timestamp()), detector)
    assert [(r["sensor_id"], r["anomaly_score"]) for r in good.collect()] == [("e1", 1.0)]
    assert {r["sensor_id"]: r["reasons"] for r in bad.collect()} == {
        "e2": ["window shape"],
        "e3": ["value not finite"],
    }


def test_scaler_is_applied_before_scoring(spark):
    scaler = scalers.Scaler("min_max", {"a": (0.0, 10.0)})
    detector = Detector("naive_forecast", 0.1, ["a"], scaler, None, 3, 1)
    df = spark.createDataFrame([("e", [[0.0], [5.0], [10.0]])], "id string, window array<array<double>>")
    assert detect(df, detector).first()["anomaly_score"] == pytest.approx(0.25)


def test_forest_scores_from_rows_equal_scores_from_windows(spark, prepared):
    detector = training.fit_detector(prepared, "isolation_forest", trees=10)
    by_rows = training.scored(prepared, detector, "val").collect()
    windows = scoring.score(prepared.windows("val"), detector).collect()
    a = {(r[0], r[1]): r["score"] for r in by_rows}
    b = {(r[0], r[1]): r["anomaly_score"] for r in windows}
    assert a.keys() == b.keys() and len(a) == 2 * 31
    # copies of a unit differ by rounding only, so single trees may part them by noise
    assert np.mean([abs(a[k] - b[k]) for k in a]) < 0.02


@pytest.mark.parametrize("name", ["isolation_forest", "reconstruction", "forecast"])
def test_filters_on_results_do_not_reach_bad_windows(spark, prepared, name):
    """Short, ragged and empty windows never meet the model, whatever is filtered later."""
    options = {"trees": 5} if name == "isolation_forest" else {}
    detector = training.fit_detector(prepared, name, **options)
    n = len(detector.features)
    short = prepared.windows("test", detector.features)
    assert scoring.score(short, detector).filter("anomaly_score >= 0").count() <= 3 * 31
    rows = [("a", [[0.5] * n] * 20), ("b", [[0.5] * n] * 7), ("c", [[0.5] * n, [0.5]]), ("d", [])]
    df = spark.createDataFrame(rows, "sensor_id string, window array<array<double>>")
    good, bad = detect_requests(df.withColumn("timestamp", F.current_timestamp()), detector)
    kept = good.filter("anomaly_score > -100 AND confidence >= 0").collect()
    assert [r["sensor_id"] for r in kept] == ["a"]
    assert bad.filter("sensor_id <> 'x'").count() == 3


def test_leaves_at_all_depths_and_missing_values():
    """Trees of unlike depth: the walk needs no node table of children, and a missing value goes left."""
    names = ["tree", "node", "feature", "split", "left", "right", "path", "depth", "rows"]
    nodes = pd.DataFrame(
        [(0, 0, 1, 0.5, 1, 2, 0.0, 0, 4), (0, 1, -1, 0.0, -1, -1, 1.0, 1, 1), (0, 2, 0, 0.5, 3, 4, 0.0, 1, 3),
         (0, 3, -1, 0.0, -1, -1, 2.5, 2, 2), (0, 4, -1, 0.0, -1, -1, 2.0, 2, 1), (3, 0, -1, 0.0, -1, -1, 0.25, 0, 1)],
        columns=names,
    )
    stacked = forests.NodeArrays.of(nodes)
    assert [len(level) for level in stacked.feature] == [2, 4] and len(stacked.path) == 8
    x = np.array([[9.0, 0.5], [0.5, 0.6], [0.6, np.inf], [np.nan, 1.0], [0.0, np.nan], [np.inf, -np.inf]])
    assert stacked.mean_path(x).tolist() == [(p + 0.25) / 2 for p in (1.0, 2.5, 2.0, 2.5, 1.0, 1.0)]
