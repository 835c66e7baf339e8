"""Structured Streaming jobs: sources, counters, status, detection and event sink."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cyclewise.constants import CYCLE, UNIT
from cyclewise.operators.drift_profile import detect_against
from cyclewise.operators.scoring import Detector, anomalies_only, detect_requests
from cyclewise.session import ROCKSDB, shared_dir
from cyclewise.sources.stores import write_event_batch


def read_stream(
    spark: SparkSession,
    folder: str,
    schema,
    pattern: str = "*.parquet",
    files_per_trigger: int = 100,
) -> DataFrame:
    """Parquet files of a folder as a stream, in bounded micro-batches."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def in_event_time(df: DataFrame, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Zone-less times become instants; watermarks accept nothing else."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def without_repeats(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drop repeated readings that arrive within the watermark."""
    return df.dropDuplicatesWithinWatermark(keys or [UNIT, CYCLE])


def counters_over_time(
    df: DataFrame, width: str = "1 hour", slide: str | None = None, time: str = "ts"
) -> DataFrame:
    """Predictions and anomalies per model version and time window."""
    return (
        df.groupBy(F.window(time, width, slide), "model_version")
        .agg(
            F.count(F.lit(1)).alias("predictions"),
            F.count_if("is_anomaly").alias("anomalies"),
            F.sum("anomaly_score").alias("score_sum"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "model_version",
            "predictions",
            "anomalies",
            "score_sum",
        )
    )


def start(
    df: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> StreamingQuery:
    """Run until the source is drained; restart with the same checkpoint to go on."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        df.writeStream.foreachBatch(handler)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def to_parquet(path: str) -> Callable[[DataFrame, int], None]:
    """Idempotent writer of one folder per batch; a repeated batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def drain(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all available input and return what it wrote.

    In complete mode that is the last batch only, as it holds the whole result.
    """
    spark = df.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    start(df, to_parquet(f"{base}/out"), f"{base}/state", mode).awaitTermination()
    out = (
        spark.read.schema(f"{_ddl(df)}, batch_id int")
        .option("basePath", f"{base}/out")
        .parquet(f"{base}/out")
    )
    if mode == "complete":
        newest = out.agg(F.max("batch_id")).first()[0]
        out = out.filter(F.col("batch_id") == newest)
    return out.drop("batch_id")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def new_requests(requests: DataFrame, request_id: str) -> DataFrame:
    """Requests whose id has not come within the watermark; a client may safely send again."""
    return requests.dropDuplicatesWithinWatermark([request_id])


def detection_sink(
    detector: Detector | Callable[[SparkSession], Detector], events_path: str, quarantine_path: str
) -> Callable[[DataFrame, int], None]:
    """Score the requests of a batch, store the anomalies, keep the rejected ones.

    A function in place of a detector is asked once per batch, so a new model version
    applies from the next batch on and never within one.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            current = detector if isinstance(detector, Detector) else detector(batch.sparkSession)
            results, rejected = detect_requests(batch, current)
            events = anomalies_only(results).withColumnRenamed("timestamp", "detected_at")
            write_event_batch(events, events_path, batch_id)
            rejected.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return handle


def drift_sink(
    profile_path: str, columns: list[str], path: str
) -> Callable[[DataFrame, int], None]:
    """Compare every batch with a kept profile of the reference and keep the decision."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            decision = detect_against(batch.sparkSession, profile_path, batch, columns)
            decision.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle
