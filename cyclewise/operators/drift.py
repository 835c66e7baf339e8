"""Two-sample drift between a reference and a current set of feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from cyclewise.constants import DRIFT_P_VALUE, DRIFT_SHARE
from cyclewise.functions.numeric import is_missing, kolmogorov_p_value
from cyclewise.functions.small_sample import exact_p_values
from cyclewise.operators.prefix import running_totals, value_counts

#: Preset report: a feature drifted from this normalised distance on, the data set from
#: this share of its features on.
PRESET_DISTANCE = 0.1
PRESET_SHARE = 0.5


def common_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns both frames have, in name order."""
    return sorted(set(reference.columns) & set(current.columns))


def stack_sides(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both sets as one, ``side`` 0 for the reference and 1 for the current rows."""
    return (
        reference.select(*columns)
        .withColumn("side", F.lit(0))
        .unionByName(current.select(*columns).withColumn("side", F.lit(1)))
    )


def unpivoted(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """``(feature, value)`` of the known values, with the columns to keep."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*keep, F.inline(entries)).filter(~is_missing(F.col("value")))


def _counts(
    reference: DataFrame, current: DataFrame, columns: list[str], buckets: int | None
) -> DataFrame:
    """Rows of both sides at every distinct value of every feature, settled.

    Either side is scanned once, to count its values; everything later reads the counts.
    """
    long = unpivoted(stack_sides(reference, current, columns), columns, "side")
    sides = {"ref": F.count_if(F.col("side") == 0), "cur": F.count_if(F.col("side") == 1)}
    return value_counts(long, "value", sides, buckets, ["feature"])


def _gap() -> Column:
    """Distance of the two distributions at a value."""
    return F.abs(
        F.try_divide(F.col("ref_upto"), F.col("ref_total"))
        - F.try_divide(F.col("cur_upto"), F.col("cur_total"))
    )


def tested(ranked: DataFrame, method: str = "asymptotic") -> DataFrame:
    """Statistic and p-value per feature from running totals of both sides."""
    statistic = F.max(_gap()).alias("statistic")
    return _p_values(_both_sided(ranked.groupBy("feature"), statistic), method)


def ks_test(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    buckets: int | None = None,
    method: str = "asymptotic",
) -> DataFrame:
    """Two-sample statistic and p-value per feature.

    A feature without values on one side has no row. ``asymptotic`` uses the limit law at
    every size; ``exact`` counts the orders of the pooled sample, which takes a time of the
    product of both sizes and is meant for samples the caller knows to be small.
    """
    columns = columns or common_columns(reference, current)
    counts = _counts(reference, current, columns, buckets)
    return tested(running_totals(counts, "value", ["ref", "cur"], ["feature"]), method)


def _both_sided(grouped: GroupedData, *measures: Column) -> DataFrame:
    """Measures per feature, only for features with values on both sides."""
    return grouped.agg(
        *measures,
        F.max("ref_total").alias("n_reference"),
        F.max("cur_total").alias("n_current"),
    ).filter((F.col("n_reference") > 0) & (F.col("n_current") > 0))


def _p_values(tested: DataFrame, method: str) -> DataFrame:
    facts = F.col("statistic"), F.col("n_reference"), F.col("n_current")
    laws = {"asymptotic": kolmogorov_p_value, "exact": exact_p_values}
    if method not in laws:
        raise ValueError(f"p-value law {method!r} is none of {sorted(laws)}")
    return tested.withColumn("p_value", laws[method](*facts))


def compare(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    buckets: int | None = None,
    method: str = "asymptotic",
) -> DataFrame:
    """Test and distance per feature from one pass.

    The first Wasserstein distance is the area between the two distributions; the step
    behind a value reaches to the next value. The normed distance is over the deviation of
    the reference, which follows from the counts as well: their mean first, then the
    squares around it.
    """
    columns = columns or common_columns(reference, current)
    counts = _counts(reference, current, columns, buckets)
    ranked = running_totals(counts, "value", ["ref", "cur"], ["feature"], "_next")
    weighted = F.sum(F.col("value") * F.col("ref"))
    means = counts.groupBy("feature").agg(F.try_divide(weighted, F.sum("ref")).alias("_mean"))
    off = F.col("value") - F.col("_mean")
    measured = _both_sided(
        ranked.join(F.broadcast(means), "feature").groupBy("feature"),  # one row per feature
        F.max(_gap()).alias("statistic"),
        F.coalesce(F.sum(_gap() * (F.col("_next") - F.col("value"))), F.lit(0.0)).alias("distance"),
        F.sqrt(F.try_divide(F.sum(F.col("ref") * off * off), F.max("ref_total"))).alias("spread"),
    )
    normed = F.col("distance") / F.greatest(F.col("spread"), F.lit(0.001))
    return _p_values(measured.withColumn("normed_distance", normed), method).drop("spread")


def wasserstein(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """First Wasserstein distance per feature, plain and over the reference deviation."""
    return compare(reference, current, columns, buckets, "asymptotic").select(
        "feature", "distance", "normed_distance", "n_reference", "n_current"
    )


def decide(
    tested: DataFrame, num_features: int, drifted: Column, score: Column, share: Column, **also: str
) -> DataFrame:
    """One-row decision from a table with one row per feature; ``also`` names further maps."""

    def by_feature(value: Column) -> Column:
        named = F.struct(F.col("feature"), value.alias("value"))
        return F.map_from_entries(F.sort_array(F.collect_list(named)))

    return (
        tested.agg(
            F.count_if(drifted).alias("num_features_drifted"),
            F.sort_array(F.collect_list(F.when(drifted, F.col("feature")))).alias(
                "drifted_features"
            ),
            by_feature(score).alias("drift_scores"),
            *[by_feature(F.col(c)).alias(name) for name, c in also.items()],
        )
        .withColumn("num_features", F.lit(num_features))
        .withColumn("is_drifted", share)
        .select(
            "is_drifted",
            "num_features",
            "num_features_drifted",
            "drifted_features",
            "drift_scores",
            *also,
        )
    )


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    p_value: float = DRIFT_P_VALUE,
    share: float = DRIFT_SHARE,
    buckets: int | None = None,
    method: str = "asymptotic",
) -> DataFrame:
    """Dataset decision: more than ``share`` of the common features drifted.

    All common features count, those without values included.
    """
    columns = columns or common_columns(reference, current)
    return decide(
        ks_test(reference, current, columns, buckets, method),
        len(columns),
        F.col("p_value") < p_value,
        F.col("p_value"),
        F.col("num_features_drifted") > F.lit(len(columns) * share),
    )


def preset_report(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    buckets: int | None = None,
    test: str = "distance",
    method: str = "asymptotic",
) -> DataFrame:
    """Decision by the named ``test``: ``distance`` (normed Wasserstein) or ``p_value``.

    ``drift_scores`` holds the numbers that decide; ``p_values`` and ``normed_distances``
    hold both, per feature.
    """
    columns = columns or common_columns(reference, current)
    both = compare(reference, current, columns, buckets, method)
    tests = {
        "distance": (F.col("normed_distance") >= PRESET_DISTANCE, F.col("normed_distance")),
        "p_value": (F.col("p_value") < DRIFT_P_VALUE, F.col("p_value")),
    }
    if test not in tests:
        raise ValueError(f"drift test {test!r} is none of {sorted(tests)}")
    drifted, score = tests[test]
    share = F.col("num_features_drifted") >= F.lit(len(columns) * PRESET_SHARE)
    maps = {"p_values": "p_value", "normed_distances": "normed_distance"}
    return decide(both, len(columns), drifted, score, share, **maps)
