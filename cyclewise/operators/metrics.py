"""Classification metrics of scored rows ``(score double, label int)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.constants import (
    HISTOGRAM_BINS,
    SEARCH_MAX,
    SEARCH_MIN,
    SEARCH_STEPS,
)
from cyclewise.functions.numeric import equal_width_bin, linspace_at, ratio, thresholds_below
from cyclewise.operators.prefix import exact_quantiles, running_totals, value_counts


def _positives() -> Column:
    return F.count_if(F.col("label") == 1)


def _negatives() -> Column:
    return F.count_if(F.col("label") == 0)


def precision_of(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall_of(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "pred") -> DataFrame:
    """The dense 2x2 matrix as one row ``tn, fp, fn, tp``."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "pred") -> DataFrame:
    """The same matrix as four rows, empty cells included."""
    cells = F.array(
        *[
            F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(n).alias("n_rows"))
            for y, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return confusion_counts(df, label, prediction).select(F.inline(cells))


def precision_recall_f1(
    df: DataFrame, label: str = "label", prediction: str = "pred"
) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion_counts(df, label, prediction).select(
        precision_of(tp, fp).alias("precision"),
        recall_of(tp, fn).alias("recall"),
        f1_of(tp, fp, fn).alias("f1"),
    )


def _ranked(df: DataFrame, buckets: int | None) -> DataFrame:
    counts = value_counts(df, "score", {"pos": _positives(), "neg": _negatives()}, buckets)
    return running_totals(counts, "score", ["pos", "neg"])


def auc_roc(df: DataFrame, buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve with ties counted half; NULL with one class only."""
    pairs = F.col("pos") * (F.col("neg_upto") - F.col("neg") + F.col("neg") / 2)
    area = _ranked(df, buckets).agg(
        F.sum(pairs.cast("double")).alias("pairs"),
        F.max("pos_total").alias("p"),
        F.max("neg_total").alias("n"),
    )
    return area.select(
        F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("pairs") / F.col("p") / F.col("n")).alias(
            "auc_roc"
        )
    )


def roc_points(df: DataFrame, buckets: int | None = None) -> DataFrame:
    """One point per distinct score: rates of ``score >= threshold``."""
    ranked = _ranked(df, buckets)
    tp = F.col("pos_total") - F.col("pos_upto") + F.col("pos")
    fp = F.col("neg_total") - F.col("neg_upto") + F.col("neg")
    return ranked.select(
        F.col("score").alias("threshold"),
        ratio(fp, F.col("neg_total"), None).alias("fpr"),
        ratio(tp, F.col("pos_total"), None).alias("tpr"),
    )


def threshold_sweep(
    df: DataFrame,
    low: float = SEARCH_MIN,
    high: float = SEARCH_MAX,
    steps: int = SEARCH_STEPS,
) -> DataFrame:
    """Metrics of ``score > threshold`` at every step, from one pass over the rows.

    Rows are counted by the number of thresholds below their score. What follows
    works on ``steps + 1`` rows, so ordering them in one task is fine.
    """
    below = df.select(thresholds_below(F.col("score"), low, high, steps).alias("k"), "label")
    counted = below.groupBy("k").agg(_positives().alias("pos"), _negatives().alias("neg"))
    every = df.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("k"))
    table = every.join(F.broadcast(counted), "k", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    summed = table.select(
        (F.col("k") - 1).alias("step"),
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(whole).alias("n_pos"),
        F.sum("neg").over(whole).alias("n_neg"),
    ).filter(F.col("step") >= 0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("n_pos") - F.col("tp")
    return summed.select(
        "step",
        linspace_at(F.col("step"), low, high, steps).alias("threshold"),
        f1_of(tp, fp, fn).alias("f1"),
        precision_of(tp, fp).alias("precision"),
        recall_of(tp, fn).alias("recall"),
        (tp + fp).alias("n_flagged"),
        (F.col("n_pos") + F.col("n_neg")).alias("n_rows"),
    )


def threshold_curve(df: DataFrame, low=SEARCH_MIN, high=SEARCH_MAX, steps=SEARCH_STEPS) -> DataFrame:
    """All steps, the first one with the highest F1 marked."""
    sweep = threshold_sweep(df, low, high, steps)
    best = sweep.agg(F.max(F.struct("f1", (-F.col("step")).alias("s"))).alias("b"))
    first_best = (-best.select("b.s").scalar()).cast("int")
    return sweep.select(
        "step",
        "threshold",
        "f1",
        "precision",
        "recall",
        (F.col("step") == first_best).alias("is_best"),
    )


def threshold_search(
    df: DataFrame,
    low: float = SEARCH_MIN,
    high: float = SEARCH_MAX,
    steps: int = SEARCH_STEPS,
    buckets: int | None = None,
) -> DataFrame:
    """The first threshold with the highest F1, as one row.

    Thresholds that flag no row or every row do not take part. If none is left the
    result is ``low`` without F1, precision and recall.
    """
    sweep = threshold_sweep(df, low, high, steps)
    usable = (F.col("n_flagged") > 0) & (F.col("n_flagged") < F.col("n_rows"))
    entry = F.struct("f1", (-F.col("step")).alias("s"), "threshold", "precision", "recall")
    best = sweep.agg(F.max(F.when(usable, entry)).alias("b"))
    return best.select(
        F.coalesce("b.threshold", F.lit(low)).alias("threshold"),
        F.col("b.f1").alias("f1"),
        F.col("b.precision").alias("precision"),
        F.col("b.recall").alias("recall"),
        auc_roc(df, buckets).scalar().alias("auc_roc"),
    )


def score_histogram(
    df: DataFrame, bins: int = HISTOGRAM_BINS, value: str = "score", by: str = "label"
) -> DataFrame:
    """Equal-width histogram per class, each over its own range, with density.

    A class with one distinct value gets the range value - 0.5 .. value + 0.5.
    """
    ranges = df.groupBy(by).agg(
        F.min(value).alias("_min"), F.max(value).alias("_max"), F.count(F.lit(1)).alias("_rows")
    )
    flat = F.col("_min") == F.col("_max")
    ranges = ranges.select(
        by,
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_lo"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("_hi"),
        "_rows",
    )
    width = (F.col("_hi") - F.col("_lo")) / bins
    # one row per class: broadcast, or all rows of a class would meet in one task
    binned = df.select(by, value).join(F.broadcast(ranges), by)
    return (
        binned.groupBy(
            by,
            equal_width_bin(F.col(value), F.col("_lo"), F.col("_hi"), bins).alias("bin"),
            "_lo",
            "_hi",
            "_rows",
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            by,
            "bin",
            (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
            "n_rows",
            (F.col("n_rows") / (F.col("_rows") * width)).alias("density"),
        )
    )


def score_normalised(df: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Min-max of the score over a set, 0 where the range is zero.

    ``low`` and ``high`` from the fit set keep scores comparable between batches;
    without them the range of ``df`` itself is used.
    """
    if low is None or high is None:
        span = df.agg(F.struct(F.min("score").alias("lo"), F.max("score").alias("hi")).alias("r"))
        row = span.scalar()
        lo, hi = row.getField("lo"), row.getField("hi")
    else:
        lo, hi = F.lit(low), F.lit(high)
    return df.withColumn("score", ratio(F.col("score") - lo, hi - lo))


def contamination_cuts(
    df: DataFrame, contaminations: list[float], exact: bool = True, buckets: int | None = None
) -> list[float]:
    """Score cuts that flag the top share of the fit set; apply as ``score > cut``."""
    shares = [1 - c for c in contaminations]
    if exact:
        return exact_quantiles(df, "score", shares, buckets)
    return df.approxQuantile("score", shares, 0.0001)


def contamination_grid(df: DataFrame, contaminations: list[float], cuts: list[float]) -> DataFrame:
    """F1 of every cut on validation rows, from one aggregate over them."""
    y = F.col("label") == 1
    counts = [
        F.count_if(cond).alias(f"{name}_{i}")
        for i, cut in enumerate(cuts)
        for name, cond in (
            ("tp", y & (F.col("score") > cut)),
            ("fp", ~y & (F.col("score") > cut)),
            ("fn", y & (F.col("score") <= cut)),
        )
    ]
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(float(c)).alias("contamination"),
            F.lit(float(cut)).alias("cut"),
            f1_of(F.col(f"tp_{i}"), F.col(f"fp_{i}"), F.col(f"fn_{i}")).alias("f1"),
        )
        for i, (c, cut) in enumerate(zip(contaminations, cuts))
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def best_of_grid(grid: DataFrame) -> DataFrame:
    return grid.orderBy(F.desc("f1"), "position").limit(1)


def model_comparison(
    runs: DataFrame, models: list[str], metrics: list[str] | None = None, missing: float | None = 0.0
) -> DataFrame:
    """Metrics by model, wide; ``runs`` holds one metric map per model."""
    metrics = metrics or ["test_f1", "test_precision", "test_recall", "test_auc_roc"]
    long = runs.select("model_type", F.explode("metrics").alias("metric", "value")).filter(
        F.col("metric").isin(metrics)
    )
    every = runs.sparkSession.createDataFrame([(m,) for m in metrics], "metric string")
    wide = long.groupBy("metric").pivot("model_type", models).agg(F.first("value"))
    table = every.join(F.broadcast(wide), "metric", "left")
    return table if missing is None else table.fillna(missing, models)


def evaluate(
    df: DataFrame,
    threshold: float,
    low: float = SEARCH_MIN,
    high: float = SEARCH_MAX,
    steps: int = SEARCH_STEPS,
) -> dict[str, DataFrame]:
    """Every evaluation table of one scored set; settle ``df`` first if it is costly."""
    decided = df.withColumn("pred", (F.col("score") > threshold).cast("int"))
    headline = precision_recall_f1(decided).withColumn("auc_roc", auc_roc(df).scalar())
    return {
        "metrics": headline,
        "confusion": confusion_matrix(decided),
        "threshold_curve": threshold_curve(df, low, high, steps),
        "roc": roc_points(df),
        "histogram": score_histogram(df),
    }
