"""Feature pipeline: drop, roll, impute, scale, window.

Rolling columns, window summaries and window arrays share one partitioning, one
sort and therefore one shuffle of the rows, see ``unit_order.open_chunks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.constants import (
    CYCLE,
    LOW_VARIANCE_SENSORS,
    ROLLING_SIZES,
    ROLLING_STATS,
    SENSORS,
    UNIT,
    WINDOW_SIZE,
)
from cyclewise.functions.arrays import keep_where
from cyclewise.operators.scalers import Scaler, feature_columns, transform_features
from cyclewise.operators.unit_order import (
    HALO,
    SPLIT,
    Layout,
    chunk_window,
    close_chunks,
    number_rows,
    open_chunks,
)

# the deviation of a single row is missing, so zero imputation makes it 0
_STATISTICS = {"mean": F.avg, "std": F.stddev_samp}


def drop_sensors(df: DataFrame, sensors: list[str] = LOW_VARIANCE_SENSORS) -> DataFrame:
    return df.drop(*sensors)


def rolling_name(sensor: str, stat: str, size: int) -> str:
    return f"{sensor}_rolling_{stat}_{size}"


def rolling_columns(
    sensors: list[str], over: WindowSpec, sizes: list[int], stats: list[str]
) -> list[Column]:
    """Rolling expressions in feature order: size, then statistic, then sensor."""
    unknown = [s for s in stats if s not in _STATISTICS]
    if unknown:
        raise ValueError(f"rolling statistics {unknown} are none of {sorted(_STATISTICS)}")
    return [
        _STATISTICS[stat](c).over(over.rowsBetween(1 - size, 0)).alias(rolling_name(c, stat, size))
        for size in sizes
        for stat in stats
        for c in sensors
    ]


def impute_zero(df: DataFrame) -> DataFrame:
    """0 for every missing number, raw sensors included, after the rolling means."""
    return df.fillna(0.0)


def _with_position(df: DataFrame, position: str | None, layout: Layout) -> tuple[DataFrame, str]:
    if position is not None:
        return df, position
    return number_rows(df, [CYCLE], position="_position", layout=layout), "_position"


def add_rolling_features(
    df: DataFrame,
    sensors: list[str],
    sizes: list[int] = ROLLING_SIZES,
    stats: list[str] = ROLLING_STATS,
    position: str | None = None,
    layout: Layout = SPLIT,
) -> DataFrame:
    """Rolling statistics per unit over rows, from one row on, then zero imputation.

    ``position`` names a gap-free row number of the unit if the frame has one;
    otherwise rows are numbered by cycle first.
    """
    present = [c for c in sensors if c in df.columns]
    frame, place = _with_position(df, position, layout)
    chunked = open_chunks(frame, max(sizes) - 1, place, layout)
    rolled = chunked.select("*", *rolling_columns(present, chunk_window(place, layout), sizes, stats))
    names = [rolling_name(c, s, w) for w in sizes for s in stats for c in present]
    return impute_zero(close_chunks(rolled).select(*df.columns, *names))


def window_array(columns: list[str], over: WindowSpec, size: int) -> Column:
    steps = F.array(*[F.col(c).cast("double") for c in columns])
    return F.collect_list(steps).over(over.rowsBetween(1 - size, 0))


def sliding_windows(
    df: DataFrame,
    columns: list[str] | None = None,
    size: int = WINDOW_SIZE,
    position: str | None = None,
    layout: Layout = SPLIT,
) -> DataFrame:
    """Full windows of ``size`` rows, stride 1; key and label are those of the last row.

    Missing values must be imputed before, as ``collect_list`` keeps the step but
    not a NULL step; a step here is an array and never NULL.
    """
    columns = columns or feature_columns(df)
    label = ["is_anomaly"] if "is_anomaly" in df.columns else []
    frame, place = _with_position(df, position, layout)
    chunked = open_chunks(frame, size - 1, place, layout)
    built = chunked.withColumn("window", window_array(columns, chunk_window(place, layout), size))
    full = close_chunks(keep_where(built, F.col(place) >= size))
    return full.select(UNIT, CYCLE, *[F.col(c).alias("label") for c in label], "window")


def _summaries(
    batches: Iterator[pa.RecordBatch], columns: list[str], kept: list[str], size: int
) -> Iterator[pa.RecordBatch]:
    """Statistics over the last ``size`` rows of the ``_full`` rows, as ``avg`` and ``stddev_pop`` have them.

    Rows come chunk by chunk, numbered by ``_row`` from 1. A step adds one row of every frame,
    in frame order, so the sums are those of a window function to the last bit.
    """
    series = np.zeros((size - 1, len(columns)))
    valid = np.ones(series.shape, bool)
    last = 0
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        row = batch.column("_row").to_numpy()
        before = np.concatenate([[last], row[:-1]])
        if not ((row == 1) | (row == before + 1)).all():
            raise RuntimeError("rows of a chunk do not follow each other")
        last = row[-1]
        values = [batch.column(c) for c in columns]
        new = np.column_stack([v.to_numpy(zero_copy_only=False) for v in values])
        known = np.column_stack([v.is_valid().to_numpy(zero_copy_only=False) for v in values])
        series, valid = np.vstack([series, np.where(known, new, 0.0)]), np.vstack([valid, known])
        n, total, mean, m2 = (np.zeros((rows, len(columns))) for _ in range(4))
        with np.errstate(invalid="ignore", over="ignore"):
            for step in range(size):
                x, k = series[step : step + rows], valid[step : step + rows]
                n += k
                total += x
                off = np.where(k, x - mean, 0.0)
                part = off / np.maximum(n, 1)
                mean += part
                m2 += off * (off - part)
            count = np.maximum(n, 1)
            found = np.hstack([total / count, np.sqrt(m2 / count)])
        series, valid = series[rows:], valid[rows:]
        empty = np.hstack([n == 0] * 2)
        statistics = [pa.array(f, mask=e, from_pandas=False) for f, e in zip(found.T, empty.T)]
        names = [f"{c}_{s}" for s in ("mean", "std") for c in columns]
        out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *statistics], [*kept, *names])
        yield out.filter(batch.column("_full"))


def window_summary(
    df: DataFrame,
    columns: list[str] | None = None,
    size: int = WINDOW_SIZE,
    position: str | None = None,
    layout: Layout = SPLIT,
) -> DataFrame:
    """Mean and population deviation per feature of every full window.

    Works on rows; the window arrays, ``size`` times the data, are never built. A window
    function numbers the rows of a chunk, which brings them together in order; the frames
    are summed for a batch of rows at once, see ``_summaries``.
    """
    columns = columns or feature_columns(df)
    label = ["is_anomaly"] if "is_anomaly" in df.columns else []
    frame, place = _with_position(df, position, layout)
    chunked = open_chunks(frame, size - 1, place, layout)
    kept = [UNIT, CYCLE, *label]
    numbered = chunked.select(
        *kept,
        *[F.col(c).cast("double").alias(f"_value_{i}") for i, c in enumerate(columns)],
        F.row_number().over(chunk_window(place, layout)).alias("_row"),
        (~F.col(HALO) & (F.col(place) >= size)).alias("_full"),
    )
    values = [f"_value_{i}" for i in range(len(columns))]
    names = [f"{v}_{s}" for s in ("mean", "std") for v in values]
    fields = [numbered.schema[c] for c in kept] + [T.StructField(c, T.DoubleType()) for c in names]
    built = numbered.mapInArrow(lambda batches: _summaries(batches, values, kept, size), T.StructType(fields))
    wanted = [f"{c}_{s}" for s in ("mean", "std") for c in columns]
    return built.select(
        UNIT,
        CYCLE,
        *[F.col(c).alias("label") for c in label],
        *[F.col(c).alias(w) for c, w in zip(names, wanted)],
    )


def engineer(
    df: DataFrame,
    sensors: list[str] = SENSORS,
    drop: list[str] = LOW_VARIANCE_SENSORS,
    sizes: list[int] = ROLLING_SIZES,
    stats: list[str] = ROLLING_STATS,
    position: str | None = None,
    layout: Layout = SPLIT,
) -> DataFrame:
    """Drop the flat sensors and add the rolling columns, not yet scaled."""
    kept = [c for c in sensors if c not in drop]
    return add_rolling_features(drop_sensors(df, drop), kept, sizes, stats, position, layout)


def build_features(
    df: DataFrame,
    scaler: Scaler | None,
    size: int = WINDOW_SIZE,
    sizes: list[int] = ROLLING_SIZES,
    stats: list[str] = ROLLING_STATS,
    drop: list[str] = LOW_VARIANCE_SENSORS,
    position: str | None = None,
    layout: Layout = SPLIT,
) -> DataFrame:
    """Drop, roll, scale and window with one shuffle.

    The chunk border copies ``rolling + window`` rows, so that the rolling values
    inside the first windows of a chunk are complete too.
    """
    frame = drop_sensors(df, drop)
    present = [c for c in SENSORS if c in frame.columns]
    frame, place = _with_position(frame, position, layout)
    over = chunk_window(place, layout)
    chunked = open_chunks(frame, max(sizes) - 1 + size - 1, place, layout)
    rolled = chunked.select("*", *rolling_columns(present, over, sizes, stats))
    names = [c for c in rolled.columns if c not in ("_chunk", "_halo", "_position")]
    features = [c for c in feature_columns(rolled.select(*names))]
    scaled = transform_features(rolled.fillna(0.0, subset=features), scaler, features)
    label = ["is_anomaly"] if "is_anomaly" in df.columns else []
    built = scaled.withColumn("window", window_array(features, over, size))
    full = close_chunks(keep_where(built, F.col(place) >= size))
    return full.select(UNIT, CYCLE, *[F.col(c).alias("label") for c in label], "window")

