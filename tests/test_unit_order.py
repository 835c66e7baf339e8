"""The split paths must give what a plain window gives, hot units included."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import features, panel, quality, unit_order
from cyclewise.operators.unit_order import (
    Layout,
    number_rows,
    open_chunks,
    previous_value,
    unit_max,
)

SCHEMA = "unit_id long, event_id long, at long, sensor_2 double, sensor_3 double"


@pytest.fixture(scope="module")
def skewed(spark):
    """One unit holds more than a third of the rows; times are bursty and tied."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        unit = 7 if i % 5 < 2 else rng.randint(100, 160)
        at = rng.choice([rng.randint(0, 50), rng.randint(0, 100_000)])
        rows.append((unit, i, at, rng.gauss(100, 10), float(rng.randint(0, 5))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5).persist()


def rows_of(df):
    return sorted(
        tuple(round(v, 8) if isinstance(v, float) else str(v) for v in r) for r in df.collect()
    )


PLAIN = Layout(10_000, 1)
LAYOUTS = [Layout(n) for n in (70, 101, 400, 5000)]


def expected_numbers(df):
    by_unit = {}
    for r in df.collect():
        by_unit.setdefault(r["unit_id"], []).append((r["at"], r["event_id"]))
    out = []
    for unit, keys in by_unit.items():
        for i, (_, event) in enumerate(sorted(keys), 1):
            out.append((event, unit, i, len(keys) - i))
    return sorted(out)


@pytest.mark.parametrize("layout", [PLAIN, Layout(3), Layout(40), *LAYOUTS], ids=str)
def test_numbers(skewed, layout):
    numbered = number_rows(skewed, ["at", "event_id"], remaining="rul", layout=layout)
    found = sorted(map(tuple, numbered.select("event_id", "unit_id", "time_cycles", "rul").collect()))
    assert found == expected_numbers(skewed)


def test_measured_layout(skewed):
    assert Layout.measured(skewed).largest == 600
    assert not Layout.measured(skewed).splits
    assert Layout.measured(skewed, hot_rows=599).splits
    assert Layout().splits


@pytest.fixture(scope="module")
def numbered(skewed):
    rows = number_rows(skewed, ["at", "event_id"], remaining="rul", layout=PLAIN)
    labeled = panel.label_anomalies(rows)
    return labeled.select("unit_id", "time_cycles", "sensor_2", "sensor_3", "rul", "is_anomaly").persist()


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_features(numbered, layout):
    sensors = ["sensor_2", "sensor_3"]
    for build in (
        lambda lay, pos: features.add_rolling_features(numbered, sensors, position=pos, layout=lay),
        lambda lay, pos: features.sliding_windows(numbered, sensors, 30, pos, lay),
        lambda lay, pos: features.window_summary(numbered, sensors, 30, pos, lay),
        lambda lay, pos: features.build_features(numbered, None, 30, position=pos, layout=lay),
    ):
        assert rows_of(build(layout, "time_cycles")) == rows_of(build(PLAIN, "time_cycles"))
        assert rows_of(build(layout, None)) == rows_of(build(PLAIN, "time_cycles"))


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_unit_max_and_rul(numbered, layout):
    bare = numbered.select("unit_id", "time_cycles")
    assert rows_of(panel.compute_rul(bare, layout)) == rows_of(
        numbered.select("unit_id", "time_cycles", "rul")
    )
    assert rows_of(unit_max(bare, "time_cycles", "m", layout=layout)) == rows_of(
        unit_max(bare, "time_cycles", "m", layout=PLAIN)
    )


@pytest.mark.parametrize("layout", [Layout(5), *LAYOUTS], ids=str)
def test_gaps(numbered, layout):
    holed = numbered.filter(F.col("time_cycles") % 17 != 0)
    wanted = rows_of(quality.gap_rows(holed, PLAIN))
    assert wanted and rows_of(quality.gap_rows(holed, layout)) == wanted
    before = previous_value(holed, "time_cycles", "b", layout=layout)
    assert before.filter("b >= time_cycles").count() == 0


def test_rolling_against_numpy(numbered):
    rows = features.add_rolling_features(
        numbered, ["sensor_2"], position="time_cycles", layout=Layout(64)
    )
    hot = sorted((r["time_cycles"], r) for r in rows.filter("unit_id = 7").collect())
    values = np.array([r["sensor_2"] for _, r in hot])
    for i in (0, 1, 4, 63, 64, 65, 128, 300, len(hot) - 1):
        for size in (5, 10, 20):
            frame = values[max(0, i + 1 - size) : i + 1]
            assert hot[i][1][f"sensor_2_rolling_mean_{size}"] == pytest.approx(frame.mean())
            deviation = frame.std(ddof=1) if len(frame) > 1 else 0.0
            assert hot[i][1][f"sensor_2_rolling_std_{size}"] == pytest.approx(deviation)


def test_chunk_must_exceed_lookback(numbered):
    with pytest.raises(ValueError, match="lookback"):
        open_chunks(numbered, 30, layout=Layout(30))


def test_any_order_can_be_cut(spark):
    rows = [(1, f"{i:03d}") for i in range(300)] + [(2, "x"), (None, "a"), (None, None)]
    df = spark.createDataFrame(rows, "unit_id long, s string")
    numbered = number_rows(df, ["s"], remaining="left", layout=Layout(40))
    found = {(r[0], r[1]): (r[2], r[3]) for r in numbered.collect()}
    assert all(found[1, f"{i:03d}"] == (i + 1, 299 - i) for i in range(300))
    assert found[2, "x"] == (1, 0) and found[None, None] == (1, 1) and found[None, "a"] == (2, 0)


@pytest.mark.parametrize("burst", ["one leading value", "one time", "no unit"])
def test_a_hot_unit_is_spread_whatever_its_order(spark, burst):
    """Bursts, one leading value for all rows, ties in the whole order, and rows without a unit."""
    limit, n = 500, 12_000
    at = {"one leading value": F.lit(5), "one time": F.when(F.col("id") < 30, F.col("id")).otherwise(10**9)}
    df = spark.range(n).select(
        F.lit(None if burst == "no unit" else 7).cast("long").alias("unit_id"),
        at.get(burst, F.col("id") % 3).cast("long").alias("at"),
        (F.col("id") if burst == "one leading value" else F.lit(0)).alias("event_id"),
        F.col("id").alias("sensor_2"),
    )
    layout = Layout.measured(df, hot_rows=limit)
    placed = unit_order.ordered_ranges(df, ["unit_id", "at", "event_id"], layout.ranges)
    tasks = placed.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("count")).first()
    assert tasks[0] <= 2 * limit and tasks[1] >= n / (2 * limit)
    numbered = number_rows(df, ["at", "event_id"], layout=layout)
    assert sorted(r[0] for r in numbered.select("time_cycles").collect()) == list(range(1, n + 1))
    if burst == "one leading value":
        assert numbered.filter("time_cycles <> event_id + 1").count() == 0
    before = previous_value(df.withColumn("time_cycles", F.col("at")), "time_cycles", "b", layout=layout)
    assert before.filter("b IS NULL").count() == 1 and before.filter("b > time_cycles").count() == 0
    steps = before.filter("b < time_cycles").count()
    assert steps == df.select("at").distinct().count() - 1
