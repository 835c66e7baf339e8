from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cyclewise.functions.decisions import unit_status
from cyclewise.operators import fleet

SCHEMA = (
    "engine_id string, cycle long, max_cycle long, anomaly_score double, is_anomaly boolean, "
    "processing_time_ms double, model_version string, sensor_id string"
)


@pytest.fixture(scope="module")
def readings(spark):
    rows = []
    for engine, last, flags in (("a", 3, {3}), ("b", 10, {10}), ("c", 10, set()), ("d", 12, {12})):
        for cycle in range(1, last + 1):
            rows.append((engine, cycle, 10 if engine != "b" else 11, cycle / 10, cycle in flags, 4.0, "m", engine))
    return spark.createDataFrame(rows, SCHEMA).persist()


@pytest.mark.parametrize(
    ("cycle", "anomaly", "status"),
    [(5, False, "healthy"), (5, True, "warning"), (90, True, "warning"), (91, True, "critical"), (91, False, "healthy"), (100, False, "failed"), (100, True, "failed")],
)
def test_status_rule(spark, cycle, anomaly, status):
    df = spark.createDataFrame([(cycle, 100, anomaly)], "c long, m long, a boolean")
    assert df.select(unit_status(F.col("c"), F.col("m"), F.col("a"))).first()[0] == status


def test_status(readings):
    found = {r["engine_id"]: r for r in fleet.fleet_status(readings).collect()}
    assert {k: r["status"] for k, r in found.items()} == {"a": "warning", "b": "critical", "c": "failed", "d": "failed"}
    assert found["d"]["cycle"] == 10 and found["a"]["lifecycle_pct"] == 30.0


def test_failure_is_final_even_if_the_last_cycle_is_lost(readings):
    lost = readings.filter("NOT (engine_id = 'd' AND cycle = 10)")
    found = {r["engine_id"]: r["status"] for r in fleet.fleet_status(lost).collect()}
    assert found["d"] == "failed"


def test_summary_keeps_silent_engines(spark, readings):
    fleet_list = spark.createDataFrame([("a",), ("d",), ("z",)], "engine_id string")
    found = {r["engine_id"]: r for r in fleet.fleet_summary(readings, fleet_list).collect()}
    assert set(found) == {"a", "d", "z"}
    assert (found["z"]["status"], found["z"]["readings"], found["z"]["anomaly_rate"]) == ("healthy", 0, 0.0)
    assert found["z"]["last_score"] is None
    assert (found["a"]["readings"], found["a"]["anomalies"]) == (3, 1)
    assert found["a"]["anomaly_rate"] == pytest.approx(100 / 3)
    assert found["d"]["readings"] == 10


def test_kpis(readings):
    row = fleet.kpis(readings).first()
    assert (row["total_readings"], row["anomalies"], row["critical_engines"]) == (33, 2, 3)
    assert row["avg_latency_ms"] == 4.0


def test_newest(readings):
    newest = fleet.newest_rows(readings, 4, "cycle", "engine_id").collect()
    assert [(r["engine_id"], r["cycle"]) for r in newest] == [("d", 12), ("d", 11), ("d", 10), ("c", 10)]
    assert fleet.latest_events(readings, "cycle", n=1).first()["engine_id"] == "d"


def test_cumulative_buckets(readings):
    rows = fleet.cumulative_buckets(readings, "anomaly_score", [0.1, 0.5, 1.0], "s").collect()
    assert [(r["le"], r["n_le"]) for r in rows] == [("0.1", 4), ("0.5", 18), ("1", 33), ("+Inf", 35)]
    assert {r["value_count"] for r in rows} == {35}


def test_counters(readings):
    assert tuple(fleet.prediction_counters(readings).first()) == ("m", 35, 3)
    assert {r["sensor_id"] for r in fleet.anomaly_counters(readings).collect()} == {"a", "b", "d"}
