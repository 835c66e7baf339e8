"""Persisted state: scalers, fitted models, runs and anomaly events."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.constants import MAX_MODEL_VERSION, MAX_SENSOR_ID
from cyclewise.operators.models.forecast import RidgeForecaster
from cyclewise.operators.models.forest import Forest
from cyclewise.operators.models.reconstruction import LinearAutoencoder
from cyclewise.operators.scalers import Scaler, scaler_from_dict
from cyclewise.operators.scoring import Detector
from cyclewise.sources import manifest

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
RUN_SCHEMA = (
    "run_id string, model_type string, stage string, start_time timestamp, "
    "params map<string,string>, metrics map<string,double>, status string"
)


# Scalers


def save_scaler(spark: SparkSession, scaler: Scaler, path: str) -> None:
    """One JSON document of a few numbers per feature column."""
    document = json.dumps(scaler.to_dict())
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(
        path
    )


def load_scaler(spark: SparkSession, path: str) -> Scaler:
    """Read a scaler document; the kind follows from its keys."""
    text = spark.read.text(path, wholetext=True).filter(F.trim("value") != "").first()
    if text is None:
        raise ValueError(f"no scaler document in {path}")
    return scaler_from_dict(json.loads(text["value"]))


# Fitted models


def save_detector(spark: SparkSession, detector: Detector, path: str) -> None:
    """Fitted tables plus one metadata document; sizes are fixed by the model, not the data."""
    model, extra = detector.model, {}
    if isinstance(model, Forest):
        spark.createDataFrame(model.nodes).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/nodes"
        )
        extra = {"sample_size": model.sample_size, "low": model.low, "high": model.high}
    elif isinstance(model, LinearAutoencoder):
        rows = [(i, float(m), w.tolist()) for i, (m, w) in enumerate(zip(model.mean, model.components))]
        spark.createDataFrame(rows, "i int, mean double, weights array<double>").write.mode(
            "overwrite"
        ).parquet(f"{path}/components")
    elif isinstance(model, RidgeForecaster):
        extra = {"weights": model.weights.tolist()}
    meta = {
        "model_type": detector.model_type,
        "threshold": detector.threshold,
        "features": detector.features,
        "scaler": detector.scaler.to_dict() if detector.scaler else None,
        "length": detector.length,
        "horizon": detector.horizon,
        "run_id": detector.run_id,
        **extra,
    }
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/meta")


def load_detector(spark: SparkSession, path: str) -> Detector:
    meta = json.loads(spark.read.text(f"{path}/meta", wholetext=True).first()["value"])
    kind, model = meta["model_type"], None
    if kind == "isolation_forest":
        nodes: pd.DataFrame = spark.read.parquet(f"{path}/nodes").toPandas()
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        model = Forest(nodes, meta["sample_size"], meta["low"], meta["high"])
    elif kind == "reconstruction":
        rows = sorted(spark.read.parquet(f"{path}/components").collect())
        model = LinearAutoencoder(np.array([r["mean"] for r in rows]), np.array([r["weights"] for r in rows]))
    elif kind == "forecast":
        model = RidgeForecaster(np.array(meta["weights"]), meta["length"], meta["horizon"])
    return Detector(
        kind,
        meta["threshold"],
        meta["features"],
        scaler_from_dict(meta["scaler"]) if meta["scaler"] else None,
        model,
        meta["length"],
        meta["horizon"],
        meta["run_id"],
    )


# Runs


def append_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    model_type: str,
    params: dict[str, str],
    metrics: dict[str, float],
    stage: str = "Production",
) -> None:
    row = [(run_id, model_type, stage, params, metrics)]
    schema = (
        "run_id string, model_type string, stage string, params map<string,string>, "
        "metrics map<string,double>"
    )
    spark.createDataFrame(row, schema).select(
        "run_id",
        "model_type",
        "stage",
        F.current_timestamp().alias("start_time"),
        "params",
        "metrics",
        F.lit("FINISHED").alias("status"),
    ).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of every model type, by start time."""
    rest = F.struct(*[c for c in runs.columns if c != "model_type"])
    return (
        runs.groupBy("model_type")
        .agg(F.max_by(rest, F.struct("start_time", "run_id")).alias("r"))
        .select("model_type", "r.*")
    )


def latest_version(runs: DataFrame, model_type: str, stage: str) -> str:
    """Run id of the newest run in a stage."""
    chosen = runs.filter((F.col("model_type") == model_type) & (F.col("stage") == stage))
    row = latest_runs(chosen).first()
    if row is None:
        raise ValueError(f"no run of {model_type!r} has the stage {stage!r}")
    return row["run_id"]


def production_detector(spark: SparkSession, runs_path: str, models_path: str, model_type: str) -> Detector:
    """The stored detector of the newest production run."""
    run_id = latest_version(read_runs(spark, runs_path), model_type, "Production")
    return load_detector(spark, f"{models_path}/{run_id}")


# Anomaly events


def _required(name: str, limit: int | None = None):
    ok = F.col(name).isNotNull()
    if limit is not None:
        ok = ok & (F.length(name) <= limit)
    reject = F.raise_error(F.lit(f"anomaly event without a valid {name}"))
    kind = EVENT_SCHEMA[name].dataType
    return F.when(ok, F.col(name)).otherwise(reject.cast(kind)).cast(kind).alias(name)


def as_events(df: DataFrame) -> DataFrame:
    """Event rows; one bad row fails the whole write, so nothing is half stored."""
    return df.select(
        _required("sensor_id", MAX_SENSOR_ID),
        _required("detected_at"),
        _required("anomaly_score"),
        _required("is_anomaly"),
        _required("confidence"),
        _required("model_version", MAX_MODEL_VERSION),
        F.current_timestamp().alias("created_at"),
    ).withColumn("detected_date", F.to_date("detected_at"))


def create_event_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, detected_date date) "
        f"USING parquet PARTITIONED BY (detected_date){place}"
    )


def append_events(df: DataFrame, table: str) -> None:
    as_events(df).write.mode("append").insertInto(table)


#: Stored events carry their day, by which they are partitioned.
STORED_EVENTS = T.StructType([*EVENT_SCHEMA.fields, T.StructField("detected_date", T.DateType())])


def write_event_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store the events of one batch: visible as a whole, and a repeated batch replaces its own."""
    manifest.write_batch(as_events(df), path, batch_id, ["detected_date"])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events of all committed batches; a filter on ``detected_date`` prunes folders."""
    return manifest.read_batches(spark, path, STORED_EVENTS)


def append_events_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    as_events(df).drop("detected_date").write.mode("append").jdbc(
        url, table, properties=properties
    )
