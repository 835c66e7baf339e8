"""From windows to decisions: scale, score, decide, confidence, version.

``detect`` is stateless, so the same chain runs on a batch and on a stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.constants import FORECAST_HORIZON, WINDOW_SIZE
from cyclewise.functions.arrays import keep_where
from cyclewise.functions.contracts import REASONS, request_reasons
from cyclewise.functions.decisions import confidence, is_above
from cyclewise.operators.models.forecast import naive_error
from cyclewise.operators.models.reconstruction import reconstruction_error
from cyclewise.operators.scalers import Scaler, transform_window

# Names of the published models and the scorer that stands for each.
MODEL_NAMES = {
    "isolation_forest": "isolation_forest",
    "lstm_ae": "reconstruction",
    "lstm_autoencoder": "reconstruction",
    "patchtst": "forecast",
    "reconstruction": "reconstruction",
    "forecast": "forecast",
    "naive_forecast": "naive_forecast",
}

RESULT_COLUMNS = ["anomaly_score", "is_anomaly", "confidence", "model_version"]


def canonical_model(name: str) -> str:
    if name not in MODEL_NAMES:
        raise ValueError(f"Unknown model type: {name}")
    return MODEL_NAMES[name]


def version_of(model_type: str, run_id: str | None = None) -> str:
    """``type:local``, or the type with the first eight characters of the run."""
    return f"{model_type}:{run_id[:8] if run_id else 'local'}"


@dataclass
class Detector:
    """A fitted scorer with everything a decision needs."""

    model_type: str
    threshold: float
    features: list[str]
    scaler: Scaler | None = None
    model: Any = None
    length: int = WINDOW_SIZE
    horizon: int = FORECAST_HORIZON
    run_id: str | None = None
    version: str = field(init=False)

    def __post_init__(self) -> None:
        self.model_type = canonical_model(self.model_type)
        self.version = version_of(self.model_type, self.run_id)


def score(df: DataFrame, detector: Detector) -> DataFrame:
    """Add ``anomaly_score`` to rows with a scaled ``window``."""
    spark, window = df.sparkSession, F.col("window")
    if detector.model_type == "isolation_forest":
        return df.withColumn(
            "anomaly_score", detector.model.score(spark, window, detector.length)
        )
    if detector.model_type == "reconstruction":
        flat = df.withColumn("_flat", F.flatten(window))
        return reconstruction_error(flat, detector.model, "_flat", "anomaly_score").drop("_flat")
    if detector.model_type == "forecast":
        return df.withColumn("anomaly_score", detector.model.error(spark, window))
    return df.withColumn(
        "anomaly_score", naive_error(window, detector.length, detector.horizon)
    )


def decide(df: DataFrame, threshold: float, version: str) -> DataFrame:
    """Add decision, confidence and version to scored rows."""
    value, cut = F.col("anomaly_score"), F.lit(float(threshold))
    return df.select(
        "*",
        is_above(value, cut).alias("is_anomaly"),
        confidence(value, cut).alias("confidence"),
        F.lit(version).alias("model_version"),
    )


def detect(df: DataFrame, detector: Detector) -> DataFrame:
    """Decisions for rows with a raw ``window``; all other columns are kept."""
    scaled = df
    if detector.scaler is not None:
        scaled = df.withColumn(
            "window", transform_window(F.col("window"), detector.scaler, detector.features)
        )
    return decide(score(scaled, detector), detector.threshold, detector.version).drop("window")


def detect_requests(df: DataFrame, detector: Detector) -> tuple[DataFrame, DataFrame]:
    """Decisions for valid requests ``(sensor_id, window, timestamp)``; the rest quarantined.

    A window that does not have the shape the model was fitted on is quarantined too.
    """
    why = request_reasons(F.col("sensor_id"), F.col("window"), F.col("timestamp"))
    shaped = F.coalesce(
        (F.size("window") == detector.length)
        & (F.size(F.get("window", F.lit(0))) == len(detector.features)),
        F.lit(False),
    )
    why = F.when((F.size(why) == 0) & ~shaped, F.array(F.lit("window shape"))).otherwise(why)
    checked = df.withColumn(REASONS, why)
    good = keep_where(checked, F.size(REASONS) == 0).drop(REASONS)
    return detect(good, detector), checked.filter(F.size(REASONS) > 0)


def anomalies_only(df: DataFrame) -> DataFrame:
    return df.filter("is_anomaly")
