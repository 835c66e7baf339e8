from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cyclewise.constants import RAW_COLUMNS
from cyclewise.operators import panel as panels
from cyclewise.operators.scalers import Scaler
from cyclewise.sources import stores
from cyclewise.sources.panel_text import ingest_test, ingest_train, read_panel, read_remaining_life, write_checked
from cyclewise.sources.tables import read_table


@pytest.fixture
def text_file(tmp_path):
    lines = []
    for unit, life in ((1, 4), (2, 3)):
        for cycle in range(1, life + 1):
            values = [f"{unit + cycle / 10:.2f}"] * 24
            lines.append(f"{unit}  {cycle} " + "  ".join(values) + "  ")
    path = tmp_path / "train.txt"
    path.write_text("\n".join(lines) + "\n\n")
    return str(path)


def test_panel_scan(spark, text_file):
    df = read_panel(spark, text_file)
    assert df.columns == RAW_COLUMNS
    assert {t for _, t in df.dtypes[:2]} == {"bigint"} and {t for _, t in df.dtypes[2:]} == {"double"}
    rows = df.orderBy("unit_id", "time_cycles").collect()
    assert len(rows) == 7
    assert rows[0]["op_setting_1"] == rows[0]["sensor_21"] == 1.1


def test_nan_and_words_become_null(spark, tmp_path):
    path = tmp_path / "odd.txt"
    path.write_text("1 1 NaN abc " + " ".join(["2"] * 22) + "\n")
    row = read_panel(spark, str(path)).first()
    assert row["op_setting_1"] is None and row["op_setting_2"] is None and row["op_setting_3"] == 2.0


def test_ingest_train(spark, text_file):
    rows = ingest_train(spark, text_file).orderBy("unit_id", "time_cycles").collect()
    assert [r["rul"] for r in rows] == [3, 2, 1, 0, 2, 1, 0]
    assert {r["is_anomaly"] for r in rows} == {1}
    assert str(rows[0]["timestamp"]) == "2024-01-01 00:00:00"
    assert str(rows[5]["timestamp"]) == "2024-01-01 01:00:01"


def test_checks_ride_along_with_the_write(spark, tmp_path):
    numbers = " ".join(["1.5"] * 24)
    lines = [f"1 {c} {numbers}" for c in (1, 2, 2, 5)] + [f"0 1 {numbers}", "2 1 " + " ".join(["x"] + ["2"] * 23)]
    (tmp_path / "train.txt").write_text("\n".join(lines))
    rows = write_checked(spark, str(tmp_path / "train.txt"), str(tmp_path / "out")).collect()
    assert [r["position"] for r in rows] == list(range(9))
    assert {r["name"]: r["detail"] for r in rows if not r["passed"]} == {
        "no_nulls": "1 nulls in columns: ['op_setting_1']",
        "repeated_keys": "1 repeated rows",
        "value_ranges": "unit_id contains values < 1",
        "cycle_gaps": "1 rows behind a gap",
        "schema_validation": "2/6 rows failed",
    }
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 6 and "_previous_cycle" not in stored.columns
    (tmp_path / "empty.txt").write_text("\n")
    empty = write_checked(spark, str(tmp_path / "empty.txt"), str(tmp_path / "none"))
    assert {r["passed"] for r in empty.collect()} == {True}


def test_ingest_test_and_labels(spark, text_file, tmp_path):
    lives = tmp_path / "rul.txt"
    lives.write_text("112\n98 \n")
    rows, rul = ingest_test(spark, text_file, str(lives))
    assert [tuple(r) for r in rul.orderBy("unit_id").collect()] == [(1, 112), (2, 98)]
    assert "timestamp" in rows.columns
    labeled = panels.label_test_panel(rows, rul).orderBy("unit_id", "time_cycles").collect()
    assert [r["rul"] for r in labeled] == [115, 114, 113, 112, 100, 99, 98]
    assert read_remaining_life(spark, str(lives)).count() == 2


def test_label_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, 1, 29), (1, 2, 30), (1, 3, 31)], "unit_id long, time_cycles long, rul long")
    assert [r["is_anomaly"] for r in panels.label_anomalies(df).orderBy("rul").collect()] == [1, 0, 0]


def test_timestamps_ignore_row_layout(spark):
    df = spark.createDataFrame([(2, 5), (1, 1), (2, 9), (1, 2)], "unit_id long, time_cycles long")
    out = panels.add_simulated_timestamps(df, "2024-06-01 12:00:00", 10)
    found = {(r[0], r[1]): str(r[2]) for r in out.collect()}
    assert found == {
        (1, 1): "2024-06-01 12:00:00",
        (1, 2): "2024-06-01 12:00:10",
        (2, 5): "2024-06-01 13:00:00",
        (2, 9): "2024-06-01 13:00:10",
    }


def test_missing_table(spark, sf_dir):
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        read_table(spark, sf_dir, "nothing")


def test_zone_less_times_become_instants(spark, sf_dir):
    assert dict(read_table(spark, sf_dir, "events").dtypes)["ts"] == "timestamp"


@pytest.mark.parametrize(
    "scaler",
    [Scaler("min_max", {"a": (1.0, 3.5)}, (0.0, 2.0)), Scaler("standard", {"a": (1.0, 0.5)})],
)
def test_scaler_files(spark, tmp_path, scaler):
    stores.save_scaler(spark, scaler, f"{tmp_path}/s")
    assert stores.load_scaler(spark, f"{tmp_path}/s") == scaler


def test_runs(spark, tmp_path):
    path = f"{tmp_path}/runs"
    for run, f1 in (("a1", 0.1), ("a2", 0.2)):
        stores.append_run(spark, path, run, "forecast", {"k": "v"}, {"test_f1": f1})
    stores.append_run(spark, path, "b1", "reconstruction", {}, {}, "Staging")
    newest = {r["model_type"]: r for r in stores.latest_runs(stores.read_runs(spark, path)).collect()}
    assert newest["forecast"]["run_id"] == "a2" and newest["forecast"]["metrics"] == {"test_f1": 0.2}
    assert newest["reconstruction"]["stage"] == "Staging"


EVENT = "sensor_id string, detected_at timestamp, anomaly_score double, is_anomaly boolean, confidence double, model_version string"


def events(spark, n=3, **changes):
    df = spark.range(n).select(
        F.format_string("engine_%03d", "id").alias("sensor_id"),
        F.timestamp_seconds(F.col("id") * 86400).alias("detected_at"),
        F.lit(0.9).alias("anomaly_score"),
        F.lit(True).alias("is_anomaly"),
        F.lit(0.5).alias("confidence"),
        F.lit("m:1").alias("model_version"),
    )
    return df.withColumns({k: F.lit(v) for k, v in changes.items()})


def test_event_batches_are_idempotent(spark, tmp_path):
    path = f"{tmp_path}/events"
    for batch in (0, 1, 1):
        stores.write_event_batch(events(spark), path, batch)
    stored = stores.read_events(spark, path)
    assert stored.count() == 6
    assert stored.filter("created_at IS NULL").count() == 0
    plan = stored.filter("detected_date = DATE'1970-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(detected_date" in plan


@pytest.mark.parametrize(
    "changes",
    [{"sensor_id": "x" * 65}, {"model_version": "m" * 129}, {"confidence": None}, {"detected_at": None}],
)
def test_bad_event_fails_the_batch(spark, tmp_path, changes):
    with pytest.raises(PySparkException, match="anomaly event without a valid"):
        stores.write_event_batch(events(spark, **changes), f"{tmp_path}/events", 0)


def test_event_table(spark, tmp_path):
    for _ in range(2):
        stores.create_event_table(spark, "cw_events", f"{tmp_path}/table")
    stores.append_events(events(spark), "cw_events")
    stores.append_events(events(spark, 1), "cw_events")
    assert spark.table("cw_events").count() == 4
    assert spark.table("cw_events").columns[:6] == [c.split()[0] for c in EVENT.split(", ")]
    spark.sql("DROP TABLE cw_events")
