from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cyclewise.functions.contracts import REASONS, reading_reasons, request_reasons, split_valid
from cyclewise.operators import quality
from cyclewise.operators.panel import add_simulated_timestamps


def report(df):
    return {r["name"]: r for r in quality.quality_report(df).collect()}


def test_clean_panel_passes(panel):
    found = report(add_simulated_timestamps(panel))
    assert list(found) == [
        "columns_present",
        "no_nulls",
        "no_duplicates",
        "column_types",
        "value_ranges",
        "temporal_continuity",
        "rul_non_negative",
        "anomaly_binary",
        "schema_validation",
    ]
    assert all(r["passed"] and r["detail"] == "" for r in found.values())


def test_faults_are_found(panel):
    broken = (
        panel.withColumn("sensor_2", F.when(F.col("time_cycles") == 3, None).otherwise(F.col("sensor_2")))
        .withColumn("sensor_3", F.when(F.col("time_cycles") == 4, float("nan")).otherwise(F.col("sensor_3")))
        .withColumn("sensor_4", F.when(F.col("time_cycles") == 5, float("inf")).otherwise(F.col("sensor_4")))
        .withColumn("rul", F.col("rul") - 1)
        .withColumn("is_anomaly", F.when(F.col("time_cycles") == 50, 2).otherwise(F.col("is_anomaly")))
        .filter("NOT (unit_id = 2 AND time_cycles = 20)")
        .drop("sensor_21")
    )
    broken = broken.unionByName(broken.filter("unit_id = 1 AND time_cycles = 7"))
    found = report(broken)
    assert found["columns_present"]["detail"] == "Missing columns: ['sensor_21']"
    assert found["no_nulls"]["detail"] == "4 nulls in columns: ['sensor_2', 'sensor_3']"
    assert found["no_duplicates"]["detail"].startswith("2 duplicate")
    assert found["value_ranges"]["detail"] == "sensor_4 contains infinite values"
    assert found["temporal_continuity"]["detail"] == "2 units have cycle gaps: [1, 2]..."
    assert not found["rul_non_negative"]["passed"] and not found["anomaly_binary"]["passed"]
    assert found["column_types"]["passed"]
    total = quality.overall(quality.quality_report(broken)).first()
    assert not total["passed"] and total["n_checks"] == 9


def test_extra_columns_are_ok(panel):
    found = quality.quality_report(panel.withColumn("note", F.lit(1))).filter("position = 0").first()
    assert found["passed"] and found["detail"] == "Extra columns (ok): ['note']"


def test_type_issues(panel):
    wrong = panel.withColumn("unit_id", F.col("unit_id").cast("double")).withColumn(
        "sensor_2", F.col("sensor_2").cast("string")
    )
    assert quality.type_issues(wrong) == ["unit_id is not integer", "sensor_2 is not numeric"]
    assert quality.type_issues(panel) == []


def test_stats(panel):
    row = quality.dataset_stats(panel).first().asDict()
    assert row == {
        "total_rows": 100,
        "num_units": 2,
        "num_columns": 28,
        "anomaly_count": 60,
        "anomaly_rate": pytest.approx(0.6),
        "min_cycles_per_unit": 50,
        "max_cycles_per_unit": 50,
        "avg_cycles_per_unit": 50.0,
        "null_count": 0,
        "duplicate_count": 0,
    }
    twice = quality.dataset_stats(panel.unionByName(panel).drop("is_anomaly")).first()
    assert twice["duplicate_count"] == 100 and twice["anomaly_count"] == 0


def test_gap_hidden_by_a_duplicate(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 4)], "unit_id long, time_cycles long")
    assert not quality.unit_continuity(df).first()["has_gap"]
    assert [tuple(r) for r in quality.gap_rows(df).collect()] == [(1, 4, 2)]


def test_reading_contract(panel):
    df = add_simulated_timestamps(panel).filter("time_cycles <= 3").withColumn(
        "rul", F.when(F.col("time_cycles") == 1, -1).otherwise(F.col("rul"))
    )
    good, bad = split_valid(df, reading_reasons(df.columns))
    assert good.count() == 4
    assert {tuple(r[REASONS]) for r in bad.collect()} == {("rul negative",)}
    assert quality.contract_violations(df).count() == 2


@pytest.mark.parametrize(
    ("sensor", "window", "reasons"),
    [
        ("engine_001", [[1.0, 2.0], [3.0, 4.0]], []),
        ("e", [[1.0]], []),
        ("x" * 64, [[1.0]], []),
        ("", [[1.0]], ["sensor_id length"]),
        ("x" * 65, [[1.0]], ["sensor_id length"]),
        (None, [[1.0]], ["sensor_id length"]),
        ("a", [], ["window empty"]),
        ("a", None, ["window empty", "step empty", "window ragged", "value not finite"]),
        ("a", [[]], ["step empty"]),
        ("a", [[1.0, 2.0], [3.0]], ["window ragged"]),
        ("a", [[1.0, float("nan")]], ["value not finite"]),
        ("a", [[float("inf"), 1.0]], ["value not finite"]),
        ("a", [[float("-inf"), 1.0]], ["value not finite"]),
        ("a", [[None, 1.0]], ["value not finite"]),
    ],
)
def test_request_contract(spark, sensor, window, reasons):
    df = spark.createDataFrame(
        [(sensor, window)], "sensor_id string, window array<array<double>>"
    ).withColumn("timestamp", F.current_timestamp())
    why = request_reasons(F.col("sensor_id"), F.col("window"), F.col("timestamp"))
    assert df.select(why).first()[0] == reasons


def test_sample_depends_on_seed(panel):
    def keys(seed):
        picked = quality.seeded_sample(panel, 10, ["unit_id", "time_cycles"], seed)
        return {(r[0], r[1]) for r in picked.collect()}

    assert keys(1) == keys(1) and len(keys(1)) == 10
    assert keys(1) != keys(2)
