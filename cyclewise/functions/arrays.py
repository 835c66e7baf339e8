"""Expressions over one window held as ``array<array<double>>`` (steps of features)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.constants import PATCH_LENGTH, PATCH_STRIDE


def keep_where(df: DataFrame, condition: Column, column: str = "window") -> DataFrame:
    """Keep the rows that meet the condition, and hand ``column`` on through a generator.

    Spark may merge a plain filter with later ones and then evaluate a model on rows the
    filter was to keep away from it, such as ragged or short windows. Expressions over a
    generated column cannot move below the generator.
    """
    return df.withColumn(column, F.explode(F.when(condition, F.array(column))))


def mean_squared_error(x: Column, y: Column) -> Column:
    """Mean over all steps and features of the squared difference."""
    squares = F.zip_with(F.flatten(x), F.flatten(y), lambda a, b: (a - b) * (a - b))
    return _sum(squares) / F.size(squares)


def forecast_input(window: Column, length: int, horizon: int) -> Column:
    check_horizon(length, horizon)
    return F.slice(window, 1, length - horizon)


def forecast_target(window: Column, length: int, horizon: int) -> Column:
    check_horizon(length, horizon)
    return F.slice(window, length - horizon + 1, horizon)


def check_horizon(length: int, horizon: int) -> None:
    if horizon >= length:
        raise ValueError(f"forecast horizon ({horizon}) must be < window length ({length})")


def last_value_forecast(inputs: Column, horizon: int) -> Column:
    """Repeat the last seen step over the horizon."""
    return F.array_repeat(F.element_at(inputs, -1), horizon)


def patch_count(length: int, size: int = PATCH_LENGTH, stride: int = PATCH_STRIDE) -> int:
    if length < size:
        raise ValueError(f"patch length ({size}) must be <= series length ({length})")
    return (length - size) // stride + 1


def patches(
    series: Column, length: int, size: int = PATCH_LENGTH, stride: int = PATCH_STRIDE
) -> Column:
    """Overlapping slices of one series of known length."""
    last = patch_count(length, size, stride) - 1
    return F.transform(
        F.sequence(F.lit(0), F.lit(last)), lambda i: F.slice(series, i * stride + 1, size)
    )


def channel(window: Column, index: int) -> Column:
    """One feature of the window as a series; ``index`` counts from 0."""
    return F.transform(window, lambda step: F.get(step, F.lit(index)))


def pick_features(window: Column, indices: list[int]) -> Column:
    return F.transform(window, lambda step: F.array(*[F.get(step, F.lit(i)) for i in indices]))


def summary_vector(window: Column, features: int) -> Column:
    """Mean of each feature, then population deviation of each feature."""
    both = [_mean_and_deviation(channel(window, i)) for i in range(features)]
    return F.array(*[m for m, _ in both], *[d for _, d in both])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _mean_and_deviation(series: Column) -> tuple[Column, Column]:
    mean = _sum(series) / F.size(series)
    squares = F.transform(series, lambda v: (v - mean) * (v - mean))
    return mean, F.sqrt(_sum(squares) / F.size(series))
