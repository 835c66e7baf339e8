"""Train and select: split, engineer, scale, fit, choose the threshold, report."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.constants import (
    CONTAMINATION_GRID,
    CYCLE,
    FORECAST_HORIZON,
    LATENT_DIM,
    SEARCH_MAX,
    SEARCH_MIN,
    SEARCH_STEPS,
    UNIT,
    WINDOW_SIZE,
)
from cyclewise.operators import features, metrics, scalers, split
from cyclewise.operators.models.forecast import fit_ridge
from cyclewise.operators.models.forest import fit_forest
from cyclewise.operators.models.reconstruction import fit_reconstruction
from cyclewise.operators.scoring import Detector, canonical_model, score
from cyclewise.operators.unit_order import Layout
from cyclewise.session import settle
from cyclewise.sources.stores import append_run, save_detector


@dataclass
class Prepared:
    """Scaled rows with their split, and the scaler fitted on the training part."""

    rows: DataFrame
    scaler: scalers.Scaler
    features: list[str]
    length: int
    position: str | None
    layout: Layout

    def part(self, name: str) -> DataFrame:
        return self.rows.filter(F.col("split") == name).drop("split")

    def windows(self, name: str, columns: list[str] | None = None) -> DataFrame:
        columns = columns or self.features
        return features.sliding_windows(
            self.part(name), columns, self.length, self.position, self.layout
        )

    def summaries(self, name: str) -> DataFrame:
        """Mean and deviation of each feature per window, straight from the rows."""
        table = features.window_summary(
            self.part(name), self.features, self.length, self.position, self.layout
        )
        order = [f"{c}_{n}" for n in ("mean", "std") for c in self.features]
        return table.select(UNIT, CYCLE, "label", F.array(*order).alias("features"))


def prepare(
    panel: DataFrame,
    length: int = WINDOW_SIZE,
    method: str = "min_max",
    position: str | None = None,
    layout: Layout | None = None,
    **split_args,
) -> Prepared:
    """Split by unit, engineer once, fit the scaler on the training rows only.

    Rolling features never cross units, so one pass serves all three splits. The
    engineered rows are settled, because the scaler fit and the windows read them.
    Without ``layout`` the rows per unit are counted first.
    """
    layout = layout or Layout.measured(panel)
    tagged = split.with_split(panel, **split_args)
    engineered = settle(
        features.engineer(tagged, position=position, layout=layout)
    )
    names = [c for c in scalers.feature_columns(engineered) if c != "split"]
    scaler = scalers.fit_scaler(engineered.filter("split = 'train'"), method, names)
    scaled = scalers.transform_features(engineered, scaler, names)
    return Prepared(scaled, scaler, names, length, position, layout)


def fit_detector(prepared: Prepared, model: str, **options) -> Detector:
    """Fit one scorer on the training part; the threshold is still open."""
    kind = canonical_model(model)
    names, length = prepared.features, prepared.length
    horizon = options.pop("horizon", FORECAST_HORIZON)
    fitted = None
    if kind == "isolation_forest":
        fitted = fit_forest(settle(prepared.summaries("train")), [UNIT, CYCLE], **options)
    elif kind == "reconstruction":
        normal = prepared.windows("train").filter("label = 0")
        fitted = fit_reconstruction(
            normal.select(F.flatten("window").alias("features")),
            len(names) * length,
            latent=options.pop("latent", LATENT_DIM),
        )
    else:
        # the forecast needs the raw channels only
        names = scalers.raw_feature_columns(names)
        if kind == "forecast":
            fitted = fit_ridge(prepared.windows("train", names), length, horizon, **options)
    return Detector(kind, 0.0, names, prepared.scaler, fitted, length, horizon)


def scored(prepared: Prepared, detector: Detector, part: str) -> DataFrame:
    """``(score, label)`` of one split; the forest never needs the window arrays."""
    if detector.model_type == "isolation_forest":
        rows = prepared.summaries(part)
        value = detector.model.score(rows.sparkSession, F.col("features"))
        return rows.select(UNIT, CYCLE, value.alias("score"), "label")
    return score(prepared.windows(part, detector.features), detector).select(
        UNIT, CYCLE, F.col("anomaly_score").alias("score"), "label"
    )


def select_threshold(prepared: Prepared, detector: Detector) -> dict[str, float]:
    """Set the threshold from validation windows; returns the validation metrics."""
    val = settle(scored(prepared, detector, "val"))
    if detector.model_type == "isolation_forest":
        train = detector.model.fit_scores  # settled by the fit, which needs their range
        if train is None:
            train = settle(scored(prepared, detector, "train"))
        cuts = metrics.contamination_cuts(train, CONTAMINATION_GRID)
        best = metrics.best_of_grid(metrics.contamination_grid(val, CONTAMINATION_GRID, cuts))
        row = best.first()
        detector.threshold = row["cut"]
        return {"val_f1": row["f1"], "best_contamination": row["contamination"]}
    row = metrics.threshold_search(val, SEARCH_MIN, SEARCH_MAX, SEARCH_STEPS).first()
    detector.threshold = row["threshold"]
    return {f"val_{k}": row[k] for k in ("f1", "precision", "recall", "auc_roc")}


def train_and_select(
    prepared: Prepared,
    model: str,
    models_path: str | None = None,
    runs_path: str | None = None,
    **options,
) -> tuple[Detector, dict[str, float]]:
    """Fit, select on validation, report on test; store model and run when asked to."""
    detector = fit_detector(prepared, model, **options)
    reported = select_threshold(prepared, detector)
    test = settle(scored(prepared, detector, "test"))
    decided = test.withColumn("pred", (F.col("score") > detector.threshold).cast("int"))
    row = (
        metrics.precision_recall_f1(decided)
        .withColumn("auc_roc", metrics.auc_roc(test).scalar())
        .first()
    )
    reported |= {f"test_{k}": row[k] for k in ("f1", "precision", "recall", "auc_roc")}
    reported["threshold"] = detector.threshold
    known = {k: float(v) for k, v in reported.items() if v is not None}
    spark = test.sparkSession
    detector = Detector(
        detector.model_type,
        detector.threshold,
        detector.features,
        detector.scaler,
        detector.model,
        detector.length,
        detector.horizon,
        uuid.uuid4().hex,
    )
    if models_path:
        save_detector(spark, detector, f"{models_path}/{detector.run_id}")
    if runs_path:
        params = {"window_size": str(prepared.length), "features": str(len(detector.features))}
        append_run(spark, runs_path, detector.run_id, detector.model_type, params, known)
    return detector, known
