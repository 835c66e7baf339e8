"""Scalers: one aggregate to fit, plain column expressions to apply.

The fitted numbers are a few per feature column, so they live on the driver and
enter the plan as literals; no join is needed to apply them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.constants import METADATA
from cyclewise.functions.numeric import is_missing


def feature_columns(df: DataFrame) -> list[str]:
    """All columns but the metadata, in frame order; operating settings included."""
    return [c for c in df.columns if c not in METADATA]


def raw_feature_columns(features: list[str]) -> list[str]:
    """Channel reduction: leave out the rolling columns."""
    return [c for c in features if "rolling" not in c]


def _known(name: str) -> Column:
    return F.when(~is_missing(F.col(name).cast("double")), F.col(name).cast("double"))


#: Keys of saved scaler files.
FILE_KEYS = {"min_max": ("min_vals", "max_vals"), "standard": ("mean_vals", "std_vals")}
RANGE_KEY = "feature_range"

UNIT_RANGE = (0.0, 1.0)


@dataclass(frozen=True)
class Scaler:
    """Two numbers per feature: its limits (``min_max``) or its mean and deviation (``standard``).

    Values are shifted and divided to the range 0 to 1 or to unit deviation; ``target`` is
    the range that 0 to 1 is stretched to.
    """

    method: str
    fitted: dict[str, tuple[float | None, float | None]]
    target: tuple[float, float] = UNIT_RANGE

    def offset_and_width(self, name: str) -> tuple[float, float] | None:
        """What is taken off and divided by; None for a feature without values."""
        first, second = self.fitted[name]
        if first is None or second is None:
            return None
        return first, second - first if self.method == "min_max" else second

    def expression(self, value: Column, name: str) -> Column:
        numbers = self.offset_and_width(name)
        if numbers is None:
            return F.lit(None).cast("double")
        offset, width = numbers
        if width == 0:
            return F.lit(0.0)
        scaled = (value - offset) / width
        if self.target == UNIT_RANGE:
            return scaled
        start, stop = self.target
        return F.lit(start) + scaled * (stop - start)

    def to_dict(self) -> dict:
        out = {
            key: {name: numbers[i] for name, numbers in self.fitted.items()}
            for i, key in enumerate(FILE_KEYS[self.method])
        }
        return out | ({RANGE_KEY: list(self.target)} if self.method == "min_max" else {})


def min_max_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row ``{c}_min, {c}_max`` for all columns, from one scan."""
    return df.agg(
        *[f(_known(c)).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    )


def mean_std_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row ``{c}_mean, {c}_std`` (sample deviation) for all columns."""
    return df.agg(
        *[
            f(_known(c)).alias(f"{c}_{n}")
            for c in columns
            for n, f in (("mean", F.avg), ("std", F.stddev_samp))
        ]
    )


def fit_scaler(
    df: DataFrame,
    method: str = "min_max",
    columns: list[str] | None = None,
    target: tuple[float, float] = UNIT_RANGE,
) -> Scaler:
    """Fit on the training rows only."""
    columns = columns or feature_columns(df)
    tables = {"min_max": min_max_table, "standard": mean_std_table}
    if method not in tables:
        raise ValueError(f"scaler {method!r} is none of {sorted(tables)}")
    row = tables[method](df, columns).first()
    return Scaler(method, {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}, target)


def scaler_from_dict(data: dict) -> Scaler:
    """The kind follows from the keys."""
    method = next(m for m, keys in FILE_KEYS.items() if keys[0] in data)
    first, second = (data[key] for key in FILE_KEYS[method])
    target = tuple(data.get(RANGE_KEY, UNIT_RANGE))
    return Scaler(method, {name: (first[name], second[name]) for name in first}, target)


def transform_features(
    df: DataFrame, scaler: Scaler | None, columns: list[str] | None = None
) -> DataFrame:
    """Scale the feature columns in one projection, pass through without a scaler."""
    if scaler is None:
        return df
    chosen = set(columns or feature_columns(df))
    return df.select(
        *[scaler.expression(F.col(c), c).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )


def transform_window(window: Column, scaler: Scaler, columns: list[str]) -> Column:
    """Scale every step of an ``array<array<double>>`` window."""
    return F.transform(
        window,
        lambda step: F.array(
            *[scaler.expression(F.get(step, F.lit(i)), c) for i, c in enumerate(columns)]
        ),
    )
