from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import drift, drift_profile, split


@pytest.fixture(scope="module")
def ten_units(spark):
    return spark.range(200).select(
        (F.col("id") % 10 + 1).alias("unit_id"), F.rand(1).alias("sensor_1")
    )


def units_of(df):
    return {r[0] for r in df.select("unit_id").distinct().collect()}


def test_split_sizes(ten_units):
    sizes = {r[0]: r[1] for r in split.unit_split(ten_units).groupBy("split").count().collect()}
    assert sizes == {"train": 7, "val": 1, "test": 2}


def test_split_is_disjoint_and_lossless(ten_units):
    frames = split.split_frames(ten_units)
    sets = {k: units_of(v) for k, v in frames.items()}
    assert set.union(*sets.values()) == set(range(1, 11))
    assert sum(len(s) for s in sets.values()) == 10
    assert sum(f.count() for f in frames.values()) == 200


def test_split_by_seed(ten_units):
    def test_units(seed):
        return units_of(split.split_frames(ten_units, seed=seed)["test"])

    assert test_units(42) == test_units(42)
    assert len({frozenset(test_units(s)) for s in range(6)}) > 1


def test_row_tags_equal_unit_list(ten_units):
    listed = {r[0]: r[1] for r in split.unit_split(ten_units, seed=5).collect()}
    for r in split.with_split(ten_units, seed=5).collect():
        assert r["split"] == listed[r["unit_id"]]


def test_tiny_split(spark):
    one = spark.createDataFrame([(1,)], "unit_id long")
    assert split.with_split(one).first()["split"] == "test"


def ks_of(a, b):
    both = np.sort(np.concatenate([a, b]))
    gap = np.searchsorted(np.sort(a), both, "right") / len(a) - np.searchsorted(
        np.sort(b), both, "right"
    ) / len(b)
    return np.abs(gap).max(), float((np.abs(gap)[:-1] * np.diff(both)).sum())


@pytest.fixture(scope="module")
def pair(spark):
    rng = np.random.default_rng(2)
    ref = np.column_stack([rng.normal(0, 1, 400), np.round(rng.exponential(3, 400)), np.full(400, 7.0)])
    cur = np.column_stack([rng.normal(0.5, 1, 300), np.round(rng.exponential(3, 300)), np.full(300, 7.0)])
    schema = "a double, b double, c double"
    return (
        spark.createDataFrame(ref.tolist(), schema),
        spark.createDataFrame(cur.tolist(), schema),
        ref,
        cur,
    )


@pytest.mark.parametrize("buckets", [3, 64])
def test_statistics_against_numpy(pair, buckets):
    ref_df, cur_df, ref, cur = pair
    found = {r["feature"]: r for r in drift.compare(ref_df, cur_df, buckets=buckets).collect()}
    for i, name in enumerate("abc"):
        statistic, distance = ks_of(ref[:, i], cur[:, i])
        assert found[name]["statistic"] == pytest.approx(statistic)
        assert found[name]["distance"] == pytest.approx(distance, abs=1e-12)
        spread = max(ref[:, i].std(), 0.001)
        assert found[name]["normed_distance"] == pytest.approx(distance / spread, abs=1e-12)
    assert found["a"]["p_value"] < 1e-6
    assert found["c"]["p_value"] == 1.0


@pytest.mark.parametrize("ranges", [1, 9])
def test_profile_equals_two_sample_test(pair, tmp_path, spark, ranges):
    """Batches inside, beside and beyond the reference, with infinite, repeated and missing values."""
    ref_df, cur_df, _, _ = pair
    inf = float("inf")
    odd = spark.createDataFrame(
        [(-inf, 1.0, 7.0), (inf, None, 7.0), (float("nan"), 1.0, None), (0.0, 1.0, 8.0)], ref_df.schema
    )
    shifted = [cur_df.select(*[(F.col(c) + by).alias(c) for c in "abc"]) for by in (1000, -1000)]
    cases = [(ref_df.unionByName(odd), [cur_df, odd, *shifted, cur_df.limit(0)]), (odd, [cur_df.limit(1)])]
    for i, (reference, batches) in enumerate(cases if ranges > 1 else [(ref_df, [cur_df])]):
        path = f"{tmp_path}/{i}"
        drift_profile.save_profile(reference, ["a", "b", "c"], path, ranges)
        for batch in batches:
            got = drift_profile.test_against(spark, path, batch, ["a", "b", "c"], 3)
            want = drift.ks_test(reference, batch, ["a", "b", "c"], 3)
            found, wanted = sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))
            assert [r[0] for r in found] == [r[0] for r in wanted]
            assert [v for r in found for v in r[1:]] == pytest.approx([v for r in wanted for v in r[1:]])


def test_batch_opens_only_the_ranges_it_touches(spark, tmp_path):
    reference = spark.range(10_000).select(F.col("id").cast("double").alias("v"))
    drift_profile.save_profile(reference, ["v"], str(tmp_path), 20)
    borders = spark.read.parquet(f"{tmp_path}/borders")
    assert 10 <= borders.count() <= 20 and borders.agg(F.sum("n")).first()[0] == 10_000
    batch = reference.filter("v BETWEEN 4000 AND 4001")
    got = drift_profile.test_against(spark, str(tmp_path), batch, ["v"]).first()
    assert got["statistic"] == pytest.approx(0.5998)
    # the reference itself is gone: the profile is all that a batch needs
    decision = drift_profile.detect_against(spark, str(tmp_path), batch.repartition(3), ["v"]).first()
    assert decision["num_features"] == 1 and decision["num_features_drifted"] == 0


def test_either_side_is_scanned_once(pair, monkeypatch):
    ref_df, cur_df, _, _ = pair
    plans = []
    from cyclewise.operators import prefix

    settled = prefix.settle
    monkeypatch.setattr(prefix, "settle", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or settled(df))
    found = drift.compare(ref_df, cur_df, ["a", "b"])
    assert len(plans) == 1 and plans[0].count("LogicalRDD") + plans[0].count("LocalRelation") == 2
    rest = found._jdf.queryExecution().optimizedPlan().toString()
    assert "double, b" not in rest and "side" not in rest


def test_p_value_of_known_case(spark):
    """The limit law gives 0.05 at 1.3581."""
    from cyclewise.functions.numeric import kolmogorov_p_value

    n = 10_000_000
    d = 1.358099 / np.sqrt(n / 2)
    row = spark.range(1).select(kolmogorov_p_value(F.lit(float(d)), F.lit(n), F.lit(n))).first()
    assert row[0] == pytest.approx(0.05, abs=2e-4)


def test_decision(pair):
    ref_df, cur_df, _, _ = pair
    row = drift.detect_drift(ref_df, cur_df).first()
    assert row["is_drifted"] and row["num_features"] == 3
    assert row["drifted_features"] == ["a"] and set(row["drift_scores"]) == {"a", "b", "c"}
    preset = drift.preset_report(ref_df, cur_df, test="p_value").first()
    assert not preset["is_drifted"] and preset["num_features_drifted"] == 1
    both = drift.preset_report(ref_df, cur_df).first()
    assert both["drift_scores"] == both["normed_distances"] and both["p_values"] == preset["drift_scores"]
    with pytest.raises(ValueError, match="drift test"):
        drift.preset_report(ref_df, cur_df, test="other")
    same = drift.detect_drift(ref_df, ref_df).first()
    assert not same["is_drifted"] and same["drifted_features"] == []


def test_features_without_values_count_but_do_not_test(spark, pair):
    ref_df, cur_df, _, _ = pair
    empty = cur_df.withColumn("b", F.lit(None).cast("double"))
    row = drift.detect_drift(ref_df, empty).first()
    assert row["num_features"] == 3 and set(row["drift_scores"]) == {"a", "c"}


def test_common_columns(pair):
    ref_df, cur_df, _, _ = pair
    assert drift.common_columns(ref_df, cur_df.drop("b").withColumn("z", F.lit(1))) == ["a", "c"]


def paths_outside(n1, n2, statistic):
    """Share of all orders of the pooled sample with at least the statistic."""
    from itertools import combinations

    hits = total = 0
    for chosen in combinations(range(n1 + n2), n1):
        taken, i, worst = set(chosen), 0, 0.0
        for k in range(n1 + n2):
            i += k in taken
            worst = max(worst, abs(i / n1 - (k + 1 - i) / n2))
        total += 1
        hits += worst >= statistic - 1e-12
    return hits / total


@pytest.mark.parametrize(("n1", "n2"), [(1, 1), (3, 4), (5, 5), (6, 4), (2, 7)])
def test_exact_p_value_against_all_orders(n1, n2):
    from cyclewise.functions.small_sample import exact_p_value

    for h in range(1, math.lcm(n1, n2) + 1):
        d = h / math.lcm(n1, n2)
        assert exact_p_value(d, n1, n2) == pytest.approx(paths_outside(n1, n2, d), abs=1e-12)


def test_exact_meets_the_limit_law(spark):
    from cyclewise.functions.numeric import kolmogorov_p_value
    from cyclewise.functions.small_sample import exact_p_value

    for n1, n2, d in ((2000, 3000, 0.04), (9000, 10_000, 0.015)):
        limit = spark.range(1).select(kolmogorov_p_value(F.lit(d), F.lit(n1), F.lit(n2))).first()[0]
        assert exact_p_value(d, n1, n2) == pytest.approx(limit, rel=0.03)


def test_method(pair):
    ref_df, cur_df, _, _ = pair
    with pytest.raises(ValueError, match="p-value law"):
        drift.ks_test(ref_df, cur_df, method="other")
    exact = {r["feature"]: r["p_value"] for r in drift.ks_test(ref_df, cur_df, method="exact").collect()}
    limit = {r["feature"]: r["p_value"] for r in drift.ks_test(ref_df, cur_df).collect()}
    assert exact["b"] == pytest.approx(limit["b"], rel=0.2)
    assert exact["c"] == 1.0
