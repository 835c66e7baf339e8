"""Exact two-sample Kolmogorov-Smirnov p-value for small samples.

Under the null every order of the pooled sample is equally likely. An order is a
lattice path from (0, 0) to (n1, n2); the p-value is the share of paths that leave
the band in which the two distributions differ by less than the statistic.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_p_value(statistic: float, n1: int, n2: int) -> float:
    step1, step2 = n2 // math.gcd(n1, n2), n1 // math.gcd(n1, n2)
    limit = round(statistic * n1 * step1)
    if limit == 0:
        return 1.0
    # paths to (i, j) inside the band, scaled; the logarithm of the scale is kept
    ways, log_scale = np.zeros(n2 + 1), 0.0
    ways[: min(n2, (limit - 1) // step2) + 1] = 1.0
    for i in range(1, n1 + 1):
        low = max(0, (i * step1 - limit) // step2 + 1)
        high = min(n2, (i * step1 + limit - 1) // step2)
        if low > high:
            return 1.0
        inside = np.cumsum(ways[low : high + 1])
        ways[:low] = 0.0
        ways[high + 1 :] = 0.0
        top = inside[-1]
        if top <= 0:
            return 1.0
        ways[low : high + 1] = inside / top
        log_scale += math.log(top)
    if ways[n2] <= 0:
        return 1.0
    log_paths = math.lgamma(n1 + n2 + 1) - math.lgamma(n1 + 1) - math.lgamma(n2 + 1)
    stays = math.exp(min(0.0, math.log(ways[n2]) + log_scale - log_paths))
    return min(1.0, max(0.0, 1.0 - stays))


def exact_p_values(statistic: Column, n1: Column, n2: Column) -> Column:
    """One value per feature row."""

    @F.pandas_udf("double")
    def tested(d: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [exact_p_value(x, int(p), int(q)) for x, p, q in zip(d, a, b)], dtype="float64"
        )

    return tested(statistic, n1, n2)
