from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, LOW_VARIANCE_SENSORS
from cyclewise.functions.arrays import (
    forecast_input,
    forecast_target,
    mean_squared_error,
    patch_count,
    patches,
    summary_vector,
)
from cyclewise.operators import features, scalers
from cyclewise.operators.unit_order import Layout


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (3.0, 30.0)], "a double, b double")


def test_min_max_fit_and_transform(small):
    scaler = scalers.fit_scaler(small)
    assert {c: numbers[0] for c, numbers in scaler.fitted.items()} == {"a": 1.0, "b": 10.0}
    assert {c: numbers[1] for c, numbers in scaler.fitted.items()} == {"a": 3.0, "b": 30.0}
    scaled = scalers.transform_features(small, scaler)
    assert column(scaled, "a") == column(scaled, "b") == [0.0, 0.5, 1.0]


def test_zero_range_and_zero_deviation_give_zero(spark):
    flat = spark.createDataFrame([(5.0,)] * 3, "a double")
    for method in ("min_max", "standard"):
        scaled = scalers.transform_features(flat, scalers.fit_scaler(flat, method))
        assert column(scaled, "a") == [0.0] * 3


def test_unseen_values_are_not_clipped(spark):
    train = spark.createDataFrame([(0.0,), (10.0,)], "a double")
    test = spark.createDataFrame([(5.0,), (20.0,)], "a double")
    assert column(scalers.transform_features(test, scalers.fit_scaler(train)), "a") == [0.5, 2.0]


def test_feature_range(small):
    scaler = scalers.fit_scaler(small, columns=["a"], target=(-1.0, 1.0))
    assert column(small.select(scaler.expression(F.col("a"), "a").alias("a")), "a") == [-1, 0, 1]


def test_standard_uses_sample_deviation(small):
    scaler = scalers.fit_scaler(small, "standard")
    assert scaler.fitted["a"][0] == pytest.approx(2.0)
    assert scaler.fitted["a"][1] == pytest.approx(1.0)
    scaled = column(scalers.transform_features(small, scaler), "a")
    assert sum(scaled) == pytest.approx(0.0, abs=1e-12)


def test_scaler_documents(small):
    for method in ("min_max", "standard"):
        scaler = scalers.fit_scaler(small, method)
        assert scalers.scaler_from_dict(scaler.to_dict()) == scaler


def test_unknown_method(small):
    with pytest.raises(ValueError, match="scaler 'invalid'"):
        scalers.fit_scaler(small, "invalid")


def test_no_scaler_passes_through(small):
    assert scalers.transform_features(small, None) is small


def test_nan_is_missing_in_fit(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "a double")
    assert scalers.fit_scaler(rows).fitted["a"][1] == 3.0
    assert scalers.fit_scaler(rows, "standard").fitted["a"][0] == 2.0


def test_drop_sensors(panel):
    kept = features.drop_sensors(panel)
    assert not set(LOW_VARIANCE_SENSORS) & set(kept.columns)
    assert {"unit_id", "sensor_2", "sensor_3"} <= set(kept.columns)
    assert features.drop_sensors(kept).columns == kept.columns


def test_rolling_columns_and_order(panel):
    rolled = features.add_rolling_features(panel, ["sensor_2", "sensor_3"], [5, 10])
    added = rolled.columns[len(panel.columns) :]
    assert added == [
        f"{c}_rolling_{stat}_{w}"
        for w in (5, 10)
        for stat in ("mean", "std")
        for c in ("sensor_2", "sensor_3")
    ]
    missing = rolled.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in rolled.columns]).first()
    assert sum(missing) == 0


def test_rolling_skips_missing_then_fills(spark):
    rows = [(1, 1, 2.0), (1, 2, None), (1, 3, float("nan")), (1, 4, 6.0)]
    df = spark.createDataFrame(rows, "unit_id long, time_cycles long, sensor_2 double")
    from cyclewise.operators.panel import canonical

    df = df.select("unit_id", "time_cycles", canonical("sensor_2"))
    out = features.add_rolling_features(df, ["sensor_2"], [3]).orderBy("time_cycles").collect()
    assert [r["sensor_2"] for r in out] == [2.0, 0.0, 0.0, 6.0]
    assert [r["sensor_2_rolling_mean_3"] for r in out] == [2.0, 2.0, 2.0, 6.0]
    assert [r["sensor_2_rolling_std_3"] for r in out] == [0.0] * 4


def test_unknown_statistic(panel):
    with pytest.raises(ValueError, match="rolling statistics"):
        features.add_rolling_features(panel, ["sensor_2"], [5], ["median"])


def test_feature_columns(panel):
    names = scalers.feature_columns(panel)
    assert "op_setting_1" in names and "sensor_2" in names
    assert not {"unit_id", "time_cycles", "rul", "is_anomaly"} & set(names)


def test_full_panel_has_101_features(panel):
    names = scalers.feature_columns(features.engineer(panel))
    assert len(names) == 101
    assert len(scalers.raw_feature_columns(names)) == 17


def test_scaled_features_in_range(panel):
    engineered = features.engineer(panel)
    scaled = scalers.transform_features(engineered, scalers.fit_scaler(engineered))
    names = scalers.feature_columns(scaled)
    row = scaled.agg(*[F.min(c).alias(f"{c}_lo") for c in names], *[F.max(c).alias(f"{c}_hi") for c in names])
    assert all(-1e-9 <= v <= 1 + 1e-9 for v in row.first())


def test_window_count_and_labels(panel):
    names = scalers.feature_columns(panel)
    built = features.sliding_windows(panel, names, 10).collect()
    assert len(built) == 2 * (50 - 10 + 1)
    assert {len(r["window"]) for r in built} == {10}
    assert {len(step) for r in built for step in r["window"]} == {len(names)}
    labels = {(r["unit_id"], r["time_cycles"]): r["is_anomaly"] for r in panel.collect()}
    assert all(labels[r["unit_id"], r["time_cycles"]] == r["label"] for r in built)


def test_window_steps_are_in_order(panel):
    built = features.sliding_windows(panel, ["time_cycles"], 5, position="time_cycles")
    for r in built.collect():
        assert [s[0] for s in r["window"]] == list(range(r["time_cycles"] - 4, r["time_cycles"] + 1))


def test_short_units_have_no_windows(spark):
    df = spark.createDataFrame(
        [(1, i, 0.5, 0) for i in range(1, 6)],
        "unit_id long, time_cycles long, sensor_2 double, is_anomaly int",
    )
    assert features.sliding_windows(df, ["sensor_2"], 10).count() == 0


def test_unlabeled_windows(panel):
    built = features.sliding_windows(panel.drop("is_anomaly", "rul"), ["sensor_2"], 10)
    assert built.columns == ["unit_id", "time_cycles", "window"]


def test_summary_from_rows_equals_summary_from_arrays(panel):
    names = ["sensor_2", "sensor_3"]
    arrays = features.sliding_windows(panel, names, 10).select(
        "unit_id", "time_cycles", summary_vector(F.col("window"), 2).alias("v")
    )
    rows = {
        (r["unit_id"], r["time_cycles"]): [r[f"{c}_{n}"] for n in ("mean", "std") for c in names]
        for r in features.window_summary(panel, names, 10).collect()
    }
    found = arrays.collect()
    assert len(found) == len(rows) == 82
    for r in found:
        assert len(r["v"]) == 4
        assert r["v"] == pytest.approx(rows[r["unit_id"], r["time_cycles"]])


def test_build_features_equals_the_steps(panel):
    engineered = features.engineer(panel)
    scaler = scalers.fit_scaler(engineered)
    names = scalers.feature_columns(engineered)
    stepwise = features.sliding_windows(scalers.transform_features(engineered, scaler), names)
    direct = features.build_features(panel, scaler)
    a = {(r[0], r[1]): r for r in stepwise.collect()}
    b = {(r[0], r[1]): r for r in direct.collect()}
    assert a.keys() == b.keys() and len(a) == 42
    for k in a:
        assert np.allclose(np.array(a[k]["window"]), np.array(b[k]["window"]))
        assert a[k]["label"] == b[k]["label"]


def test_window_transform_equals_row_transform(panel):
    names = ["sensor_2", "sensor_3"]
    scaler = scalers.fit_scaler(panel, columns=names)
    raw = features.sliding_windows(panel, names, 5)
    in_window = raw.select("unit_id", "time_cycles", scalers.transform_window(F.col("window"), scaler, names).alias("w"))
    rowwise = features.sliding_windows(scalers.transform_features(panel, scaler, names), names, 5)
    a = {(r[0], r[1]): r["w"] for r in in_window.collect()}
    for r in rowwise.collect():
        assert np.allclose(a[r[0], r[1]], r["window"])


def test_forecast_split(panel):
    built = features.sliding_windows(panel, ["sensor_2"], 30)
    r = built.select(
        "window",
        forecast_input(F.col("window"), 30, 10).alias("x"),
        forecast_target(F.col("window"), 30, 10).alias("y"),
    ).first()
    assert r["x"] + r["y"] == r["window"]
    assert (len(r["x"]), len(r["y"])) == (20, 10)
    with pytest.raises(ValueError, match="forecast horizon"):
        forecast_input(F.col("window"), 10, 10)


def test_patches(spark):
    df = spark.createDataFrame([([float(i) for i in range(20)],)], "s array<double>")
    cut = df.select(patches(F.col("s"), 20).alias("p")).first()["p"]
    assert len(cut) == patch_count(20) == 4
    assert [p[0] for p in cut] == [0.0, 4.0, 8.0, 12.0]
    assert {len(p) for p in cut} == {8}
    with pytest.raises(ValueError):
        patch_count(7)


def test_mean_squared_error(spark):
    df = spark.sql("select array(array(1D, 2D), array(3D, 4D)) x, array(array(1D, 0D), array(0D, 4D)) y")
    assert df.select(mean_squared_error(F.col("x"), F.col("y"))).first()[0] == pytest.approx(13 / 4)


def test_window_summary_equals_the_window_functions_over_batches(spark):
    """The same bits as avg and stddev_pop, over missing and odd values, small batches and chunks."""
    from pyspark.sql import Window

    rng = np.random.default_rng(9)
    rows = []
    for unit, n in ((1, 90), (2, 3), (3, 41), (4, 7)):
        for cycle in range(1, n + 1):
            odd = None if (unit, cycle // 9) == (3, 1) or cycle % 13 == 0 else float("nan") if cycle == 37 else 0.1 if unit == 4 else float(rng.normal(1e3, 5))
            rows.append((unit, cycle, odd, float(rng.normal()), cycle % 2))
    df = spark.createDataFrame(rows, "unit_id long, time_cycles long, sensor_2 double, sensor_3 double, is_anomaly int")
    over = Window.partitionBy("unit_id").orderBy("time_cycles").rowsBetween(-6, 0)
    names = [(f, f"{c}_{s}", c) for s, f in (("mean", F.avg), ("std", F.stddev_pop)) for c in ("sensor_2", "sensor_3")]
    wanted = df.select("unit_id", "time_cycles", F.col("is_anomaly").alias("label"), *[f(c).over(over).alias(n) for f, n, c in names])
    wanted = wanted.filter("time_cycles >= 7").orderBy("unit_id", "time_cycles").collect()
    known = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for layout in (Layout(1_000, 90), Layout(20, 90)):
            found = features.window_summary(df, ["sensor_2", "sensor_3"], 7, CYCLE, layout)
            assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
            assert str(found.orderBy("unit_id", "time_cycles").collect()) == str(wanted)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", known)
