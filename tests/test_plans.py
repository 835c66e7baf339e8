"""The shape of the plans: shuffles, pruning, pushed filters, no Python where not needed."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cyclewise.operators import features
from cyclewise.operators.scalers import Scaler, transform_features
from cyclewise.operators.unit_order import Layout
from cyclewise.plans import fixtures
from cyclewise.sources.tables import read_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan_of(df)))


def test_one_shuffle_for_the_feature_pipeline(spark, sf_dir):
    rows, layout = fixtures.user_readings(spark, sf_dir)
    assert not layout.splits
    built = features.build_features(rows, None, position="time_cycles", layout=layout)
    assert exchanges(built) == 1


def test_split_features_shuffle_stored_rows_once(spark, panel):
    built = features.build_features(panel, None, position="time_cycles")
    assert exchanges(built) == 1
    assert "hashpartitioning(unit_id" in plan_of(built) and "_chunk" in plan_of(built)


def test_rolling_columns_share_one_window_node(spark, panel):
    rolled = features.add_rolling_features(panel, ["sensor_2", "sensor_3"], position="time_cycles", layout=Layout(10**6, 1))
    assert len(re.findall(r"\n[ +\-:]*Window ", plan_of(rolled))) == 1


def test_scan_reads_the_needed_columns(spark, sf_dir):
    rows, _ = fixtures.user_readings(spark, sf_dir)
    plan = rows._jdf.queryExecution().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def test_filters_reach_the_scan(spark, sf_dir):
    df = read_table(spark, sf_dir, "events").filter("user_id = 3 AND value > 10").select("value")
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(value), EqualTo(user_id,3), GreaterThan(value,10.0)]" in plan_of(df)


def test_unit_filter_passes_the_window(spark, sf_dir):
    rows, _ = fixtures.user_readings(spark, sf_dir)
    assert "EqualTo(user_id,3)" in plan_of(rows.filter(F.col("unit_id") == 3))


def test_scaling_is_a_projection_without_join(spark, panel):
    scaler = Scaler("min_max", {"sensor_2": (0.0, 1.0)})
    plan = plan_of(transform_features(panel.select("unit_id", "sensor_2"), scaler))
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("name", ["flagship_features", "threshold_search", "ks_drift", "fleet_summary", "quality_report"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    import __spark_entry__ as entry

    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
