"""A drained stream gives what the batch gives, in one or in many micro-batches."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, UNIT
from cyclewise.operators import drift, drift_profile, features
from cyclewise.operators.fleet import fleet_status
from cyclewise.operators.scoring import Detector
from cyclewise.operators.unit_order import number_rows
from cyclewise.sources import manifest, stores
from cyclewise.streaming import jobs, status
from cyclewise.streaming.processor import EventTimeRing, as_steps, rolling_statistics, stream_features

SCHEMA = "unit_id long, event_id long, ts timestamp, sensor_2 double, sensor_3 double"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Readings in five files, one per micro-batch, in event order between files."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        unit = 1 if i % 3 == 0 else int(rng.integers(2, 6))
        value = None if i % 29 == 0 else float(rng.normal(10, 2))
        rows.append((unit, i, 1_700_000_000 + i // 2, value, float(rng.normal(5, 1))))
    df = spark.createDataFrame(
        rows, "unit_id long, event_id long, s long, sensor_2 double, sensor_3 double"
    ).select("unit_id", "event_id", F.timestamp_seconds("s").alias("ts"), "sensor_2", "sensor_3")
    folder = str(tmp_path_factory.mktemp("readings"))
    for part in range(5):
        piece = df.filter(F.floor(F.col("event_id") / 80) == part)
        piece.coalesce(1).write.mode("append").parquet(folder)
    return folder, df.persist()


def stream(spark, folder, files=1, delay="1 hour"):
    read = jobs.read_stream(spark, folder, SCHEMA, files_per_trigger=files)
    return jobs.in_event_time(read, delay=delay)


def by_key(rows, *names):
    return {tuple(r[k] for k in names): r for r in rows}


@pytest.mark.parametrize("files", [1, 5])
def test_stream_features_equal_batch(spark, source, files):
    folder, df = source
    sensors = ["sensor_2", "sensor_3"]
    timed = stream(spark, folder, files, "0 seconds")
    out = jobs.drain(stream_features(timed, sensors, window=12))
    out = out.withColumn("window", as_steps(F.col("window"), 2))
    assert out.filter("is_late").count() == 0
    numbered = number_rows(df, ["ts", "event_id"])
    batch = features.add_rolling_features(numbered, sensors, position=CYCLE)
    found = by_key(out.collect(), UNIT, CYCLE)
    wanted = by_key(batch.collect(), UNIT, CYCLE)
    assert found.keys() == wanted.keys() and len(found) == 400
    names = [c for c in batch.columns if c.startswith("sensor_")]
    for k, r in wanted.items():
        assert [found[k][c] for c in names] == pytest.approx([r[c] for c in names], abs=1e-9)
    windows = by_key(
        features.sliding_windows(batch, sensors, 12, position=CYCLE).collect(), UNIT, CYCLE
    )
    full = {k: r["window"] for k, r in found.items() if r["window"] is not None}
    assert full.keys() == windows.keys()
    for k in full:
        assert np.allclose(full[k], windows[k]["window"])


def test_restart_goes_on_and_late_rows_stay_out(spark, source, tmp_path):
    _, df = source
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def feed(rows):
        rows.coalesce(1).write.mode("append").parquet(folder)
        streamed = stream_features(
            jobs.in_event_time(jobs.read_stream(spark, folder, SCHEMA), delay="0 seconds"),
            ["sensor_3"],
            window=5,
        )
        jobs.start(streamed, jobs.to_parquet(out), state).awaitTermination()
        return spark.read.parquet(out)

    feed(df.filter("event_id BETWEEN 100 AND 199"))
    feed(df.filter("event_id >= 200"))
    result = feed(df.filter("event_id < 50"))
    assert result.filter("NOT is_late").count() == 300
    assert {r["tie"] for r in result.filter("is_late").collect()} == set(range(50))
    numbered = number_rows(df.filter("event_id >= 100"), ["ts", "event_id"])
    batch = features.add_rolling_features(numbered, ["sensor_3"], position=CYCLE)
    wanted = by_key(batch.collect(), UNIT, CYCLE)
    found = by_key(result.filter("NOT is_late").collect(), UNIT, CYCLE)
    assert found.keys() == wanted.keys()
    for k in wanted:
        name = "sensor_3_rolling_std_20"
        assert found[k][name] == pytest.approx(wanted[k][name], abs=1e-9)


@pytest.mark.parametrize("runs", [1, 3])
def test_shuffled_arrival_within_the_delay_equals_batch(spark, source, tmp_path, runs):
    """Readings reach the stream in random order, up to 60 seconds late."""
    _, df = source
    jitter = F.pmod(F.xxhash64("event_id"), F.lit(60))
    placed = df.withColumn("place", F.floor((F.unix_seconds("ts") + jitter - 1_700_000_000) / 50))
    for place in sorted(r[0] for r in placed.select("place").distinct().collect()):
        part = placed.filter(F.col("place") == place).drop("place").orderBy(F.rand(3))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if runs > 1 or place == 5:
            timed = stream(spark, f"{tmp_path}/in", 1, "120 seconds")
            featured = stream_features(timed, ["sensor_2"], sizes=[5])
            jobs.start(featured, jobs.to_parquet(f"{tmp_path}/out"), f"{tmp_path}/state").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.filter("is_late").count() == 0
    newest = df.agg(F.max(F.unix_seconds("ts"))).first()[0]
    numbered = number_rows(df.filter(F.unix_seconds("ts") <= newest - 120), ["ts", "event_id"])
    batch = features.add_rolling_features(numbered, ["sensor_2"], [5], position=CYCLE)
    found, wanted = by_key(out.collect(), UNIT, CYCLE), by_key(batch.collect(), UNIT, CYCLE)
    assert found.keys() == wanted.keys() and len(found) > 100
    for k, r in wanted.items():
        assert found[k]["tie"] == r["event_id"]
        for name in ("sensor_2_rolling_mean_5", "sensor_2_rolling_std_5"):
            assert found[k][name] == pytest.approx(r[name], abs=1e-9)


def test_rows_without_a_time_or_unit(spark, tmp_path):
    rows = [(1, 1, 10, 1.0), (1, 2, None, 2.0), (None, 3, 20, 3.0), (None, 4, 5, None), (1, None, 10, 4.0)]
    df = spark.createDataFrame(rows, "unit_id long, event_id long, s long, sensor_2 double")
    df = df.select("unit_id", "event_id", F.timestamp_seconds("s").alias("ts"), "sensor_2", F.lit(0.0).alias("sensor_3"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    out = jobs.drain(stream_features(stream(spark, f"{tmp_path}/in", 1, "0 seconds"), ["sensor_2"], window=2))
    late = out.filter("is_late").collect()
    assert [(r["tie"], r["sensor_2"]) for r in late] == [(2, 2.0)]
    found = {(r[UNIT], r[CYCLE]): (r["tie"], r["sensor_2"], r["window"]) for r in out.filter("NOT is_late").collect()}
    assert found == {
        (1, 1): (-1, 4.0, None), (1, 2): (1, 1.0, [4.0, 1.0]), (None, 1): (4, 0.0, None), (None, 2): (3, 3.0, [0.0, 3.0]),
    }


def test_rolling_statistics():
    series = np.array([[1.0], [np.nan], [3.0], [8.0]])
    mean, std = rolling_statistics(series, 3)
    assert mean.ravel() == pytest.approx([1.0, 1.0, 2.0, 5.5])
    assert std.ravel() == pytest.approx([0.0, 0.0, np.std([1, 3], ddof=1), np.std([3, 8], ddof=1)])
    flat = rolling_statistics(np.full((9, 1), 0.1), 5)[1]
    assert (flat < 1e-15).all()


def scored(df):
    return df.select(
        "ts",
        F.format_string("engine_%03d", UNIT).alias("engine_id"),
        F.col("event_id").alias("cycle"),
        F.lit(350).cast("long").alias("max_cycle"),
        (F.col("sensor_3") / 10).alias("anomaly_score"),
        (F.col("sensor_3") > 6).alias("is_anomaly"),
        F.lit("m").alias("model_version"),
    )


def test_counters_equal_batch(spark, source):
    folder, df = source
    found = jobs.drain(jobs.counters_over_time(scored(stream(spark, folder)), "1 minute"), "complete")
    wanted = jobs.counters_over_time(scored(df), "1 minute")
    a, b = by_key(found.collect(), "window_start"), by_key(wanted.collect(), "window_start")
    assert a.keys() == b.keys() and len(a) > 2
    for k in a:
        assert (a[k]["predictions"], a[k]["anomalies"]) == (b[k]["predictions"], b[k]["anomalies"])
        assert a[k]["score_sum"] == pytest.approx(b[k]["score_sum"])


def test_append_counters_wait_for_the_watermark(spark, source):
    folder, _ = source
    timed = jobs.in_event_time(
        jobs.read_stream(spark, folder, SCHEMA, files_per_trigger=1), delay="30 seconds"
    )
    out = jobs.drain(jobs.counters_over_time(scored(timed), "1 minute"))
    closed = out.agg(F.sum("predictions")).first()[0]
    assert 0 < closed < 400


def test_sliding_counters(spark, source):
    folder, df = source
    out = jobs.drain(
        jobs.counters_over_time(scored(stream(spark, folder)), "2 minutes", "1 minute"), "complete"
    )
    assert out.agg(F.sum("predictions")).first()[0] == 800


def test_status_equals_batch(spark, source):
    folder, df = source
    found = jobs.drain(fleet_status(scored(stream(spark, folder))), "complete")
    wanted = fleet_status(scored(df))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert {r["status"] for r in found.collect()} == {"failed"}


def test_status_log_writes_changes_only(spark, source, tmp_path):
    folder, df = source
    for mode in ("first", "again"):  # the second start finds nothing new
        changes = status.status_changes(scored(stream(spark, folder)), "ts")
        jobs.start(changes, status.to_log(f"{tmp_path}/log"), f"{tmp_path}/state", "update").awaitTermination()
    wanted = sorted(map(tuple, fleet_status(scored(df)).collect()))
    assert sorted(map(tuple, status.current_status(spark, f"{tmp_path}/log").collect())) == wanted
    log = manifest.read_batches(spark, f"{tmp_path}/log", status.LOGGED)
    assert log.count() > log.select("engine_id").distinct().count()
    # past its life an engine changes no more
    last = log.groupBy("engine_id").agg(F.max("cycle").alias("c")).collect()
    assert all(r["c"] <= 350 for r in last)
    status.compact(spark, f"{tmp_path}/log")
    assert len(manifest.committed(spark, f"{tmp_path}/log")) == 1
    assert sorted(map(tuple, status.current_status(spark, f"{tmp_path}/log").collect())) == wanted


def test_silent_engines_leave_the_state_not_the_log(spark, tmp_path):
    kind = "engine_id string, cycle long, max_cycle long, anomaly_score double, is_anomaly boolean, ts timestamp"

    def feed(*rows):
        df = spark.createDataFrame([(e, c, 10, 0.1, False, s) for e, c, s in rows], kind.replace("timestamp", "long"))
        df.withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        read = jobs.in_event_time(jobs.read_stream(spark, f"{tmp_path}/in", kind), delay="0 seconds")
        changes = status.status_changes(read, "ts", 60_000)
        jobs.start(changes, status.to_log(f"{tmp_path}/log"), f"{tmp_path}/state", "update").awaitTermination()

    feed(("a", 5, 1000), ("b", 5, 1000))
    feed(("b", 6, 1050), ("c", 1, 1061))  # the watermark passes a's time to live
    feed(("a", 4, 1080))  # a is new to the state, so an older cycle counts as a change
    log = manifest.read_batches(spark, f"{tmp_path}/log", status.LOGGED)
    assert sorted((r[0], r[1]) for r in log.select("engine_id", "cycle").collect()) == [
        ("a", 4), ("a", 5), ("b", 5), ("b", 6), ("c", 1)
    ]


def test_failure_is_final(spark, tmp_path):
    kind = "engine_id string, cycle long, max_cycle long, anomaly_score double, is_anomaly boolean"

    def feed(*rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        read = jobs.read_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], kind).schema)
        changes = status.status_changes(read)
        jobs.start(changes, status.to_log(f"{tmp_path}/log"), f"{tmp_path}/state", "update").awaitTermination()
        return {r[0]: tuple(r)[1:] for r in status.current_status(spark, f"{tmp_path}/log").collect()}

    assert feed(("a", 95, 100, 0.5, True), ("b", 1, 10, 0.1, False), ("d", None, 10, 0.1, False)) == {
        "a": (95, 100, 95.0, 0.5, "critical"), "b": (1, 10, 10.0, 0.1, "healthy"),
    }
    assert feed(("a", 101, 100, 0.0, False), ("c", 12, 10, 0.2, True))["a"] == (95, 100, 95.0, 0.5, "failed")
    now = feed(("a", 96, 100, 0.0, False), ("b", 1, 10, 0.9, True))
    assert now["a"] == (96, 100, 96.0, 0.0, "failed")
    assert now["b"] == (1, 10, 10.0, 0.1, "healthy") and now["c"] == (None, None, None, None, "failed")


def test_uncommitted_batch_is_invisible_then_replaced(spark, tmp_path):
    path, schema = f"{tmp_path}/store", spark.range(1).withColumn("day", F.lit(1)).schema
    rows = spark.range(10).withColumn("day", (F.col("id") % 2).cast("int"))
    manifest.write_batch(rows, path, 0, ["day"])
    manifest.write_data(rows.withColumn("id", F.col("id") + 100), path, 1, ["day"])  # dies before its commit

    def ids(condition="true"):
        found = manifest.read_batches(spark, path, schema).filter(condition).collect()
        return sorted(r["id"] for r in found)

    assert ids() == list(range(10))
    manifest.write_batch(rows.filter("id < 3").withColumn("id", F.col("id") + 200), path, 1, ["day"])
    assert ids() == [*range(10), 200, 201, 202]
    manifest.write_batch(rows.filter("id < 2"), path, 0, ["day"])  # a repeated batch replaces its own
    assert ids() == [0, 1, 200, 201, 202] and ids("day = 1") == [1, 201]
    manifest.merge_batches(spark, path, schema, 1, ["day"])
    assert ids() == [0, 1, 200, 201, 202] and list(manifest.committed(spark, path)) == [1]
    assert manifest.read_batches(spark, f"{tmp_path}/none", schema).count() == 0
    plan = manifest.read_batches(spark, path, schema).filter("day = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_repeats_are_dropped(spark, source):
    folder, _ = source
    doubled = stream(spark, folder).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    assert jobs.drain(jobs.without_repeats(doubled, ["unit_id", "event_id"])).count() == 400


def test_detection_job(spark, source, tmp_path):
    folder, _ = source
    requests = stream(spark, folder).select(
        F.format_string("engine_%03d", UNIT).alias("sensor_id"),
        F.when(F.col("event_id") % 4 == 0, F.array(F.array(F.lit(float("nan")))))
        .otherwise(F.array(F.array("sensor_3"), F.array(F.lit(5.0))))
        .alias("window"),
        F.col("ts").alias("timestamp"),
        "event_id",
    )
    detector = Detector("naive_forecast", 1.0, ["s"], None, None, 2, 1)
    sink = jobs.detection_sink(detector, f"{tmp_path}/events", f"{tmp_path}/bad")
    jobs.start(requests, sink, f"{tmp_path}/state").awaitTermination()
    stored = stores.read_events(spark, f"{tmp_path}/events")
    _, df = source
    wanted = df.filter("event_id % 4 <> 0 AND (sensor_3 - 5) * (sensor_3 - 5) > 1").count()
    assert stored.count() == wanted > 0
    assert stored.filter("NOT is_anomaly").count() == 0
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 100


def test_drift_per_batch(spark, source, tmp_path):
    folder, df = source
    shifted = df.withColumn("sensor_3", F.col("sensor_3") + 5)
    drift_profile.save_profile(shifted, ["sensor_3"], f"{tmp_path}/profile")
    handler = jobs.drift_sink(f"{tmp_path}/profile", ["sensor_3"], f"{tmp_path}/drift")
    jobs.start(stream(spark, folder), handler, f"{tmp_path}/state").awaitTermination()
    decisions = spark.read.parquet(f"{tmp_path}/drift")
    assert decisions.count() == 5 and decisions.filter("NOT is_drifted").count() == 0
    assert not drift.detect_drift(df, df, ["sensor_3"]).first()["is_drifted"]


class _State:
    """A state variable of one key that counts the calls on it."""

    def __init__(self, calls):
        self.calls, self.value = calls, None

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            if name == "exists":
                return self.value is not None
            if name == "get":
                return self.value
            if name == "appendValue":
                self.value = [*(self.value or []), given[0]]
            elif name in ("update", "put"):
                self.value = given[0]
            elif name == "clear":
                self.value = None

        return call


def test_units_of_a_bucket_share_calls_and_frames():
    """State calls and frames do not grow with the units, nor do units mix; over three firings."""
    rng = np.random.default_rng(3)
    n, units = 4_000, 500
    frame = pd.DataFrame({UNIT: rng.integers(0, units, n), "event_us": rng.permutation(n) * 1_000_000, "tie": np.arange(n), "sensor_2": rng.normal(size=n)})
    frame.loc[::11, "sensor_2"] = np.nan
    calls, frames = [], []
    handle = SimpleNamespace(
        getValueState=lambda *_: _State(calls), getListState=lambda *_: _State(calls),
        registerTimer=lambda *_: calls.append("register"), deleteTimer=lambda *_: calls.append("delete"),
    )
    ring = EventTimeRing(["sensor_2"], [5], 7)
    ring.init(handle)
    at = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    assert not list(ring.handleInputRows((3,), iter([frame[:1500], frame[1500:]]), at(0)))
    for passed in (1_000_000, 1_500_000, 10_000_000):
        frames += ring.handleExpiredTimer((3,), at(passed), None)
    assert len(calls) < 50 and len(frames) < 5
    found = pd.concat(frames).sort_values("tie", ignore_index=True)
    frame = frame.sort_values([UNIT, "event_us"])
    by_unit = frame.groupby(UNIT)["sensor_2"]
    frame["cycle"] = by_unit.cumcount() + 1
    frame["mean"] = by_unit.transform(lambda v: v.rolling(5, min_periods=1).mean()).fillna(0.0)
    windows = {t: w for _, g in frame.fillna(0.0).groupby(UNIT) for t, w in zip(g["tie"][6:], np.lib.stride_tricks.sliding_window_view(g["sensor_2"], 7) if len(g) > 6 else [])}
    frame = frame.sort_values("tie", ignore_index=True)
    assert found[UNIT].tolist() == frame[UNIT].tolist() and found[CYCLE].tolist() == frame["cycle"].tolist()
    assert np.allclose(found["sensor_2_rolling_mean_5"], frame["mean"])
    full = found[found["window"].notna()]
    assert set(full["tie"]) == set(windows)
    assert all(np.array_equal(w, windows[t]) for t, w in zip(full["tie"], full["window"]))
