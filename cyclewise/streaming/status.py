"""Latest status of every engine as a log of changes.

State holds one small row per engine: its newest reading within its life, and whether it
has failed, which is final. A micro-batch passes on only the engines whose row changed, so
the cost follows the batch and not the fleet. With a time to live, an engine whose newest
event time is that far behind the watermark leaves the state; what the log says of it stays.

The log is a store of committed batches. ``current_status`` is the last change of every
engine; ``compact`` rewrites the log as one such batch.

Defined results: a reading without a cycle is skipped; among readings of the same cycle the
first to arrive counts; an engine whose readings are all past its life has failed and has
no cycle and no score; a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cyclewise.functions.decisions import lifecycle_pct, unit_status
from cyclewise.sources import manifest

KNOWN = T.StructType(
    [
        T.StructField("cycle", T.LongType()),
        T.StructField("max_cycle", T.LongType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("failed", T.BooleanType()),
    ]
)
CHANGES = T.StructType([T.StructField("engine_id", T.StringType()), *KNOWN.fields])
LOGGED = T.StructType([*CHANGES.fields, T.StructField("change", T.LongType())])
UNTIL = T.StructType([T.StructField("until_ms", T.LongType())])
#: An engine may be silent for this long in event time, in milliseconds, before its state goes.
TIME_TO_LIVE_MS = 90 * 86_400_000


class StatusKeeper(StatefulProcessor):
    """Keeps the newest reading and the failure of an engine; passes on changes only."""

    def __init__(self, time_to_live_ms: int | None) -> None:
        self.time_to_live_ms = time_to_live_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", KNOWN)
        self.until = handle.getValueState("until", UNTIL)

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        before = tuple(self.known.get()) if self.known.exists() else None
        cycle, end, score, anomaly, failed = before or (None, None, None, None, False)
        newest = None
        for frame in rows:
            frame = frame[frame["cycle"].notna()]
            if self.time_to_live_ms is not None and frame["event_ms"].notna().any():
                newest = max(newest or 0, int(frame["event_ms"].max()))
            failed = failed or bool((frame["cycle"] >= frame["max_cycle"]).any())
            alive = frame[frame["cycle"] <= frame["max_cycle"]]
            if len(alive):
                best = alive.loc[alive["cycle"].idxmax()]
                if cycle is None or best["cycle"] > cycle:
                    cycle, end = int(best["cycle"]), int(best["max_cycle"])
                    score = None if pd.isna(best["anomaly_score"]) else float(best["anomaly_score"])
                    anomaly = None if pd.isna(best["is_anomaly"]) else bool(best["is_anomaly"])
        if newest is not None:
            self._live(newest + self.time_to_live_ms)
        after = (cycle, end, score, anomaly, failed)
        if after == before or (cycle is None and not failed):
            return
        self.known.update(after)
        out = pd.DataFrame([(key[0], *after)], columns=CHANGES.names)
        yield out.astype({"cycle": "Int64", "max_cycle": "Int64", "is_anomaly": "boolean"})

    def _live(self, until_ms: int) -> None:
        """Move the timer that ends the state; never to an earlier time."""
        if self.until.exists():
            (known,) = self.until.get()
            if known >= until_ms:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(until_ms)
        self.until.update((until_ms,))

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        self.known.clear()
        self.until.clear()
        return iter(())

    def close(self) -> None:
        pass


def status_changes(
    readings: DataFrame, time: str | None = None, time_to_live_ms: int = TIME_TO_LIVE_MS
) -> DataFrame:
    """A stream of the engines whose newest reading or failure changed, in update mode.

    ``time`` names a column with a watermark; without it state is kept for good.
    """
    given = readings.select(
        "engine_id",
        F.col("cycle").cast("long"),
        F.col("max_cycle").cast("long"),
        F.col("anomaly_score").cast("double"),
        "is_anomaly",
        (F.unix_millis(time) if time else F.lit(None).cast("long")).alias("event_ms"),
    )
    return given.groupBy("engine_id").transformWithStateInPandas(
        statefulProcessor=StatusKeeper(time_to_live_ms if time else None),
        outputStructType=CHANGES,
        outputMode="Update",
        timeMode="EventTime" if time else "None",
    )


def to_log(path: str) -> Callable[[DataFrame, int], None]:
    """Sink of the changes; a repeated batch replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        manifest.write_batch(batch.withColumn("change", F.lit(batch_id).cast("long")), path, batch_id)

    return write


def _last_changes(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of every engine; a failure is never taken back."""
    log = manifest.read_batches(spark, path, LOGGED)
    rest = F.struct(*[c for c in LOGGED.names if c != "engine_id"])
    place = F.struct("failed", "change")
    return log.groupBy("engine_id").agg(F.max_by(rest, place).alias("r")).select("engine_id", "r.*")


def compact(spark: SparkSession, path: str) -> None:
    """Replace the log by the last change of every engine, in one commit."""
    known = manifest.committed(spark, path)
    if len(known) > 1:
        last = max(known)
        folder = manifest.write_data(_last_changes(spark, path), path, last)
        manifest.commit(spark, path, last, folder, [b for b in known if b != last])


def current_status(spark: SparkSession, path: str) -> DataFrame:
    """Status of each engine after its newest reading."""
    cycle, end = F.col("cycle"), F.col("max_cycle")
    return _last_changes(spark, path).select(
        "engine_id",
        "cycle",
        "max_cycle",
        lifecycle_pct(cycle, end).alias("lifecycle_pct"),
        "anomaly_score",
        F.when(F.col("failed"), "failed")
        .otherwise(unit_status(cycle, end, F.col("is_anomaly")))
        .alias("status"),
    )
