"""Forecast error: the last steps of a window against a forecast from the first ones.

Channels share one weight matrix. The normal equations need only the lag moments,
a matrix of fixed size that every partition sums up on its own; one pass over the
windows fits all horizon steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.constants import FORECAST_HORIZON, WINDOW_SIZE
from cyclewise.functions.arrays import (
    check_horizon,
    forecast_input,
    forecast_target,
    last_value_forecast,
    mean_squared_error,
)


def naive_error(window: Column, length: int, horizon: int = FORECAST_HORIZON) -> Column:
    """Error of repeating the last seen step; a plain column expression."""
    seen = forecast_input(window, length, horizon)
    return mean_squared_error(
        forecast_target(window, length, horizon), last_value_forecast(seen, horizon)
    )


def _channels(column: pa.Array, length: int) -> np.ndarray:
    """``(windows, channels, steps)`` of a nested list column."""
    n = len(column)
    flat = column.flatten().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, length, -1).transpose(0, 2, 1)


def _lag_moments(windows: DataFrame, length: int, horizon: int) -> np.ndarray:
    lags = length - horizon
    size = lags + 1 + horizon

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((lags + 1, size))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            series = _channels(batch.column(0), length).reshape(-1, length)
            ones = np.ones((len(series), 1))
            x = np.hstack([ones, series[:, :lags]])
            total += x.T @ np.hstack([x, series[:, lags:]])
        rows, columns = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows.ravel().astype(np.int32)),
                pa.array(columns.ravel().astype(np.int32)),
                pa.array(total.ravel()),
            ],
            names=["i", "j", "v"],
        )

    sums = (
        windows.select("window")
        .mapInArrow(partial, "i int, j int, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    moments = np.zeros((lags + 1, size))
    for r in sums:
        moments[r["i"], r["j"]] = r["v"]
    return moments


@dataclass
class RidgeForecaster:
    """Weights ``(1 + lags, horizon)``, the first row is the intercept."""

    weights: np.ndarray
    length: int
    horizon: int

    model_type = "forecast"

    def error(self, spark: SparkSession, window: Column) -> Column:
        length, lags = self.length, self.length - self.horizon
        shared = spark.sparkContext.broadcast(self.weights)

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            if len(column) == 0:
                return pa.array([], pa.float64())
            series = _channels(column, length)
            weights = shared.value
            expected = weights[0] + series[:, :, :lags] @ weights[1:]
            return pa.array(((series[:, :, lags:] - expected) ** 2).mean(axis=(1, 2)))

        return score(window)


def fit_ridge(
    windows: DataFrame,
    length: int = WINDOW_SIZE,
    horizon: int = FORECAST_HORIZON,
    ridge: float = 1e-6,
) -> RidgeForecaster:
    """Least squares with a penalty of ``ridge`` per observation on the lag weights."""
    check_horizon(length, horizon)
    moments = _lag_moments(windows, length, horizon)
    lags = length - horizon
    n = moments[0, 0]
    if n == 0:
        raise ValueError("no windows to fit on")
    penalty = np.diag([0.0] + [ridge * n] * lags)
    weights = np.linalg.solve(moments[:, : lags + 1] + penalty, moments[:, lags + 1 :])
    return RidgeForecaster(weights, length, horizon)
