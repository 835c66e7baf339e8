"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(c: Column) -> Column:
    """NULL or NaN; only for floating-point columns."""
    return c.isNull() | F.isnan(c)


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & ~is_infinite(c)


def ratio(top: Column, bottom: Column, default: float | None = 0.0) -> Column:
    """``top / bottom``, ``default`` where the denominator is zero."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(default).cast("double"))


def linspace_step(low: float, high: float, steps: int) -> float:
    return (high - low) / (steps - 1) if steps > 1 else 0.0


def linspace_at(index: Column, low: float, high: float, steps: int) -> Column:
    """Value ``index`` (from 0) of ``steps`` evenly spaced values."""
    return F.lit(low) + index * F.lit(linspace_step(low, high, steps))


def linspace(low: float, high: float, steps: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: linspace_at(i, low, high, steps)
    )


def thresholds_below(score: Column, low: float, high: float, steps: int) -> Column:
    """How many of the evenly spaced thresholds are strictly below ``score``.

    The closed form can be one off where the score sits on a threshold, so it is
    compared with its two neighbours.
    """
    step = linspace_step(low, high, steps)
    if step <= 0:
        return F.when(score > low, F.lit(steps)).otherwise(F.lit(0))
    guess = F.least(F.greatest(F.ceil((score - low) / step), F.lit(0)), F.lit(steps)).cast("int")
    down = (guess > 0) & (score <= linspace_at(guess - 1, low, high, steps))
    up = (guess < steps) & (score > linspace_at(guess, low, high, steps))
    return F.when(down, guess - 1).when(up, guess + 1).otherwise(guess)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin index from 0; the last bin is closed, a zero-width range goes to the middle."""
    raw = F.floor((value - low) / (high - low) * bins)
    return (
        F.when(high > low, F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)))
        .otherwise(F.lit(bins // 2))
        .cast("int")
    )


def kolmogorov_p_value(statistic: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided Kolmogorov-Smirnov p-value.

    Uses the classic small-sample correction of the effective size. Decisions
    close to p = 0.05 on small samples can differ from an exact test.
    """
    a, b = n1.cast("double"), n2.cast("double")  # the product of two counts exceeds a long
    effective = F.sqrt(a * b / (a + b))
    x = (effective + 0.12 + 0.11 / effective) * statistic
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * x * x),
    )
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))
