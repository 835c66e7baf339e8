"""Event-time ring buffer: rolling features and full windows per unit on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cyclewise.constants import CYCLE, ROLLING_SIZES, UNIT, WINDOW_SIZE
from cyclewise.operators.features import rolling_name

#: Rows whose features are computed and passed on at once.
CHUNK_ROWS = 5_000

#: Groups of units that share one entry of the state; part of the state, so kept by a stream.
BUCKETS = 1_024
#: Bucket of the readings without a unit.
NO_UNIT = -1
BUCKET = "_bucket"

#: Rows of numpy records, see ``EventTimeRing``.
PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
TIMER = T.StructType([T.StructField("expiry_ms", T.LongType())])


def output_schema(sensors: list[str], sizes: list[int], window: int | None) -> T.StructType:
    rolled = [
        T.StructField(rolling_name(c, stat, size), T.DoubleType())
        for size in sizes
        for stat in ("mean", "std")
        for c in sensors
    ]
    windows = [T.StructField("window", T.ArrayType(T.DoubleType()))] if window else []
    return T.StructType(
        [
            T.StructField(UNIT, T.LongType()),
            T.StructField(CYCLE, T.LongType()),
            T.StructField("event_us", T.LongType()),
            T.StructField("tie", T.LongType()),
            *[T.StructField(c, T.DoubleType()) for c in sensors],
            *rolled,
            *windows,
            T.StructField("is_late", T.BooleanType()),
        ]
    )


def rolling_statistics(
    series: np.ndarray, size: int, place: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample deviation over the last ``size`` rows, missing values skipped.

    Frames at the start are shorter; without enough values the result is 0. ``place`` is the
    place of each row in its unit, from 0, where rows of several units follow each other.
    """
    padded = np.vstack([np.full((size - 1, series.shape[1]), np.nan), series])
    frames = np.lib.stride_tricks.sliding_window_view(padded, size, axis=0)
    known = ~np.isnan(frames)
    if place is not None:
        known &= (np.arange(size - 1, -1, -1) <= place[:, None])[:, None, :]
    n = known.sum(axis=-1)
    mean = np.where(known, frames, 0.0).sum(axis=-1) / np.maximum(n, 1)
    off = np.where(known, frames - mean[..., None], 0.0)
    return mean, np.sqrt((off * off).sum(axis=-1) / np.maximum(n - 1, 1))


class EventTimeRing(StatefulProcessor):
    """Holds rows until the watermark has passed them, then the last rows of each unit.

    A row at or before the watermark, which counts in milliseconds, is late: it is passed on
    at once with ``is_late`` and never changes the features of other rows, as is a row
    without a time. All others wait
    in state, in any order. A timer of the earliest waiting row fires when the watermark
    reaches it; the rows passed by then are ordered by time and tie-breaker, numbered and
    given their features. So the order of arrival within the delay does not matter, and
    what has been passed on is final.

    The key is a bucket of units, and what is done is done for all units of a bucket at once,
    so the cost is one per row and not one per unit. Waiting rows and rings are numpy
    records, sorted by unit in the ring.
    """

    def __init__(self, sensors: list[str], sizes: list[int], window: int | None) -> None:
        self.sensors = sensors
        self.sizes = sizes
        self.window = window
        self.keep = max([window or 1, *sizes]) - 1
        self.names = output_schema(sensors, sizes, window).names
        channels = len(sensors)
        self.row = np.dtype([("unit", "i8"), ("at", "i8"), ("tie", "i8"), ("values", "f8", (channels,))])
        # the last ``held`` rows of ``tail`` are the last rows of the unit
        self.entry = np.dtype(
            [("unit", "i8"), ("seen", "i8"), ("held", "i8"), ("tail", "f8", (self.keep, channels))]
        )

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", PACKED)
        self.timer = handle.getValueState("timer", TIMER)
        self.waiting = handle.getListState("waiting", PACKED)

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        passed_ms = timerValues.getCurrentWatermarkInMs()
        earliest = None
        for frame in rows:
            at = frame["event_us"]
            late = at.isna()
            if passed_ms > 0:
                late = late | (at // 1000 <= passed_ms)
            if late.any():
                yield self._late(key, frame[late])
            fresh = frame[~late]
            if len(fresh):
                packed = np.zeros(len(fresh), self.row)
                packed["unit"] = fresh[UNIT]
                packed["at"] = fresh["event_us"].astype("int64")
                packed["tie"] = fresh["tie"].fillna(-1).astype("int64")
                packed["values"] = fresh[self.sensors].to_numpy(dtype=float)
                self.waiting.appendValue((packed.tobytes(),))
                first = int(packed["at"].min())
                earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake(earliest // 1000 - 1)

    def _wake(self, expiry_ms: int) -> None:
        """Have a timer no later than ``expiry_ms``, and one timer only."""
        if self.timer.exists():
            (known,) = self.timer.get()
            if known <= expiry_ms:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(expiry_ms)
        self.timer.update((expiry_ms,))

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        passed_ms = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        rows = np.concatenate([np.frombuffer(packed, self.row) for (packed,) in self.waiting.get()])
        ready = rows["at"] // 1000 <= passed_ms
        rest = rows[~ready]
        if len(rest):
            self.waiting.put([(rest.tobytes(),)])
            self._wake(max(int(rest["at"].min()) // 1000 - 1, passed_ms))
        else:
            self.waiting.clear()
        rows = rows[ready]
        yield from self._emit(key, rows[np.lexsort((rows["tie"], rows["at"], rows["unit"]))])

    def _emit(self, key: Any, rows: np.ndarray) -> Iterator[pd.DataFrame]:
        """Features of rows that are sorted by unit, time and tie-breaker."""
        if not len(rows):
            return
        units, of_row = np.unique(rows["unit"], return_inverse=True)
        ring = np.zeros(0, self.entry)
        if self.ring.exists():
            ring = np.frombuffer(self.ring.get()[0], self.entry)
        renewed = np.isin(ring["unit"], units)
        own = np.zeros(len(units), self.entry)
        own["unit"] = units
        own[np.searchsorted(units, ring["unit"][renewed])] = ring[renewed]

        # rows of the ring before the new rows of each unit
        held = np.arange(self.keep) >= self.keep - own["held"][:, None]
        of_tail = np.repeat(np.arange(len(units)), own["held"])
        segment = np.concatenate([of_tail, of_row])
        order = np.argsort(segment, kind="stable")
        series = np.vstack([own["tail"][held], rows["values"]])[order]
        segment = segment[order]
        begin = np.searchsorted(segment, np.arange(len(units)))
        end = np.append(begin[1:], len(segment))
        place = np.arange(len(segment)) - begin[segment]
        fresh = place >= own["held"][segment]
        cycle = own["seen"][segment] + place - own["held"][segment] + 1
        done = np.cumsum(fresh) - fresh
        for lo in range(0, len(series), CHUNK_ROWS):
            hi, back = min(lo + CHUNK_ROWS, len(series)), max(0, lo - self.keep)
            new = np.flatnonzero(fresh[lo:hi]) + lo
            if len(new):
                part = rows[done[new[0]] : done[new[-1]] + 1]
                yield self._features(key, part, cycle[new], series[back:hi], place[back:hi], new - back)

        own["seen"] = cycle[end - 1]
        last = np.arange(-self.keep, 0) + end[:, None]
        kept = last >= begin[:, None]
        own["tail"] = np.where(kept[..., None], series[np.maximum(last, 0)], 0.0)
        own["held"] = kept.sum(axis=1)
        both = np.concatenate([ring[~renewed], own])
        self.ring.update((both.tobytes(),))

    def _units(self, key: Any, units: Any) -> Any:
        return pd.array([None] * len(units), dtype="Int64") if key[0] == NO_UNIT else np.asarray(units)

    def _late(self, key: Any, rows: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({UNIT: self._units(key, rows[UNIT])})
        for name in ("event_us", "tie", *self.sensors):
            out[name] = rows[name].to_numpy()
        for name in self.names:
            if name not in out:
                out[name] = None
        out["is_late"] = True
        return out[self.names]

    def _features(
        self, key: Any, rows: np.ndarray, cycle: np.ndarray, series: np.ndarray, place: np.ndarray, new: np.ndarray
    ) -> pd.DataFrame:
        """Features of ``rows``, which are at ``new`` in ``series``."""
        filled = np.nan_to_num(series)
        out: dict[str, Any] = {
            UNIT: self._units(key, rows["unit"]),
            CYCLE: cycle,
            "event_us": rows["at"],
            "tie": rows["tie"],
            **{c: filled[new, i] for i, c in enumerate(self.sensors)},
        }
        for size in self.sizes:
            for stat, table in zip(("mean", "std"), rolling_statistics(series, size, place)):
                for i, c in enumerate(self.sensors):
                    out[rolling_name(c, stat, size)] = table[new, i]
        if self.window:
            flat, width = filled.ravel(), filled.shape[1]  # every window is a view of one array
            out["window"] = [
                flat[(i + 1 - self.window) * width : (i + 1) * width] if full else None
                for i, full in zip(new.tolist(), (place[new] + 1 >= self.window).tolist())
            ]
        out["is_late"] = False
        return pd.DataFrame(out)[self.names]

    def close(self) -> None:
        pass


def as_steps(window: Column, channels: int) -> Column:
    """A flat window as an array of steps."""
    steps = F.sequence(F.lit(0), (F.size(window) / channels).cast("int") - 1)
    return F.when(
        window.isNotNull(),
        F.transform(steps, lambda i: F.slice(window, i * channels + 1, F.lit(channels))),
    )


def stream_features(
    readings: DataFrame,
    sensors: list[str],
    time: str = "ts",
    tie: str = "event_id",
    sizes: list[int] = ROLLING_SIZES,
    window: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rolling columns, and on request the raw window where it is full, of every reading.

    ``readings`` needs a watermark on ``time``; its delay is how late a reading may come
    without being late, and how long results wait. Readings of the last delay wait in state
    when the input ends. A unit's order is serial by nature: a task holds the readings of
    a bucket of units that wait, bounded by the delay and the source's rate option
    (``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``), plus a ring of ``window - 1`` rows
    for each of its units. ``buckets`` rises with the stream and stays the same over restarts.
    ``window`` is flat, step by step; see ``as_steps``.
    """
    unit = F.col(UNIT).cast("long")
    # a new expression for the time: the engine would drop late rows, here they are passed on
    keyed = readings.select(
        F.when(unit.isNull(), NO_UNIT).otherwise(F.pmod(F.xxhash64(unit), F.lit(buckets))).alias(BUCKET),
        F.coalesce(unit, F.lit(0)).alias(UNIT),
        F.unix_micros(time).alias("event_us"),
        F.col(tie).cast("long").alias("tie"),
        *[F.col(c).cast("double").alias(c) for c in sensors],
    )
    return keyed.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=EventTimeRing(sensors, sizes, window),
        outputStructType=output_schema(sensors, sizes, window),
        outputMode="Append",
        timeMode="EventTime",
    )
