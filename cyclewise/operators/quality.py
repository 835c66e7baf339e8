"""Data-quality checks.

All value checks come from one chain of aggregates: rows -> keys -> units -> one
row. Every step combines before it shuffles, so a hot unit is no problem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.constants import (
    CYCLE,
    LABEL_COLUMNS,
    RAW_COLUMNS,
    SEED,
    UNIT,
)
from cyclewise.functions.contracts import REASONS, reading_reasons
from cyclewise.functions.numeric import is_infinite
from cyclewise.operators.unit_order import SPLIT, Layout, previous_value

SHOWN_UNITS = 5


def _missing(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _sensors(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("sensor_")]


def quote(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def column_issues(df: DataFrame, expected: list[str] = RAW_COLUMNS) -> tuple[list[str], list[str]]:
    """Missing and extra column names."""
    missing = sorted(set(expected) - set(df.columns))
    extra = sorted(set(df.columns) - set(expected) - set(LABEL_COLUMNS))
    return missing, extra


def type_issues(df: DataFrame) -> list[str]:
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    issues = [f"{c} is not integer" for c in (UNIT, CYCLE) if not isinstance(kinds[c], whole)]
    measured = [c for c in df.columns if c.startswith(("sensor_", "op_setting_"))]
    return issues + [
        f"{c} is not numeric" for c in measured if not isinstance(kinds[c], T.NumericType)
    ]


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column as rows ``(column, n_null)``."""
    counted = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in df.columns])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null"))
                    for c in df.columns
                ]
            )
        )
    )


def range_flags(df: DataFrame) -> DataFrame:
    """One row: ids or cycles below 1, and infinite values per sensor."""
    return df.agg(
        F.bool_or(F.col(UNIT) < 1).alias("unit_below_1"),
        F.bool_or(F.col(CYCLE) < 1).alias("cycle_below_1"),
        *[
            F.bool_or(F.coalesce(is_infinite(F.col(c)), F.lit(False))).alias(f"inf_{c}")
            for c in _sensors(df)
        ],
    )


def _not_binary() -> Column:
    """A label outside 0 and 1; a missing label is one."""
    return ~F.coalesce(F.col("is_anomaly").isin(0, 1), F.lit(False))


def label_flags(df: DataFrame) -> DataFrame:
    """One row: readings with a negative remaining life, and labels outside 0 and 1."""
    return df.agg(
        F.count_if(F.col("rul") < 0).alias("negative_rul"),
        F.count_if(_not_binary()).alias("not_binary"),
    )


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Keys that occur more than once, with the number of copies."""
    return df.groupBy(UNIT, CYCLE).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def unit_continuity(df: DataFrame) -> DataFrame:
    """Rows and cycle range per unit; a gap shows as fewer rows than the range."""
    per_unit = df.groupBy(UNIT).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(CYCLE).alias("first_cycle"),
        F.max(CYCLE).alias("last_cycle"),
    )
    expected = F.col("last_cycle") - F.col("first_cycle") + 1
    return per_unit.withColumn("has_gap", F.col("n_rows") != expected)


def gap_rows(df: DataFrame, layout: Layout = SPLIT) -> DataFrame:
    """Rows whose preceding cycle in the unit is not the previous number.

    Unlike the count test it sees a gap that a duplicate hides.
    """
    before = previous_value(df.select(UNIT, CYCLE), CYCLE, "previous_cycle", layout=layout)
    return before.filter(F.col(CYCLE) - F.col("previous_cycle") > 1)


def contract_violations(df: DataFrame) -> DataFrame:
    """Rows that break the reading contract, with the reasons."""
    return df.withColumn(REASONS, reading_reasons(df.columns)).filter(F.size(REASONS) > 0)


def seeded_sample(
    df: DataFrame, n: int, keys: list[str], seed: int = SEED
) -> DataFrame:
    """A sample of ``n`` rows that depends on the keys and the seed only."""
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(text), *keys).limit(n)


def check_sample(df: DataFrame, n: int = 100, seed: int = SEED) -> DataFrame:
    """The row contract on a seeded sample; the report itself checks every row."""
    sample = seeded_sample(df, n, [UNIT, CYCLE], seed)
    return sample.agg(
        F.count(F.lit(1)).alias("n_sampled"),
        F.count_if(F.size(reading_reasons(df.columns)) > 0).alias("n_failed"),
    )


def _facts(df: DataFrame) -> DataFrame:
    """Everything the value checks and the statistics need, as one row.

    Value counters are one aggregate over all columns, without a shuffle of rows. Copies,
    gaps and cycle ranges come from a second chain that reads the two key columns only.
    """
    sensors = _sensors(df)
    labeled = "is_anomaly" in df.columns
    has_rul = "rul" in df.columns
    total, biggest = {}, {}
    for c in df.columns:
        total[f"null:{c}"] = F.count_if(_missing(df, c))
    for c in sensors:
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            biggest[f"inf:{c}"] = F.max(is_infinite(F.col(c)).cast("int"))
    total["bad_rows"] = F.count_if(F.size(reading_reasons(df.columns)) > 0)
    if labeled:
        total["anomalies"] = F.sum(F.col("is_anomaly").cast("long"))
        total["not_binary"] = F.count_if(_not_binary())
    if has_rul:
        total["negative_rul"] = F.count_if(F.col("rul") < 0)
    values = df.agg(*[c.alias(n) for n, c in {**total, **biggest}.items()])
    keys = df.groupBy(UNIT, CYCLE).agg(F.count(F.lit(1)).alias("copies"))
    units = keys.groupBy(UNIT).agg(
        F.sum("copies").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.when(F.col("copies") > 1, F.col("copies")).otherwise(0)).alias("in_duplicates"),
        F.min(CYCLE).alias("first_cycle"),
        F.max(CYCLE).alias("last_cycle"),
    )
    gap = F.col("n_rows") != F.col("last_cycle") - F.col("first_cycle") + 1
    ranges = units.agg(
        F.sum("n_rows").alias("total_rows"),
        F.count(UNIT).alias("num_units"),
        F.sum("n_keys").alias("n_keys"),
        F.sum("in_duplicates").alias("in_duplicates"),
        F.count_if(gap).alias("gap_units"),
        F.min(UNIT).alias("lowest_unit"),
        F.min("first_cycle").alias("lowest_cycle"),
        F.min("last_cycle").alias("min_cycles_per_unit"),
        F.max("last_cycle").alias("max_cycles_per_unit"),
        F.avg("last_cycle").alias("avg_cycles_per_unit"),
    )
    facts = ranges.unionByName(values, allowMissingColumns=True)  # two rows, each fact known in one
    return facts.agg(*[F.max(f"`{c}`").alias(c) for c in facts.columns])


def _null_total(df: DataFrame) -> Column:
    total = F.lit(0)
    for c in df.columns:
        total = total + F.col(f"`null:{c}`")
    return total


def dataset_stats(df: DataFrame) -> DataFrame:
    """Summary record; a duplicate is every copy after the first."""
    labeled = "is_anomaly" in df.columns
    return _facts(df).select(
        "total_rows",
        "num_units",
        F.lit(len(df.columns)).alias("num_columns"),
        (F.col("anomalies") if labeled else F.lit(0).cast("long")).alias("anomaly_count"),
        (F.col("anomalies") / F.col("total_rows") if labeled else F.lit(0.0)).alias("anomaly_rate"),
        "min_cycles_per_unit",
        "max_cycles_per_unit",
        "avg_cycles_per_unit",
        _null_total(df).cast("long").alias("null_count"),
        (F.col("total_rows") - F.col("n_keys")).alias("duplicate_count"),
    )


def _names_where(flags: dict[str, Column]) -> Column:
    listed = F.array(*[F.when(cond, F.lit(name)) for name, cond in flags.items()])
    return F.filter(listed, lambda n: n.isNotNull())


def _quoted(names: Column) -> Column:
    return F.concat(
        F.lit("["), F.concat_ws(", ", F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'")))), F.lit("]")
    )


def _first_gap_units(df: DataFrame) -> Column:
    first = unit_continuity(df).filter("has_gap").orderBy(UNIT).limit(SHOWN_UNITS)
    listed = first.agg(F.concat_ws(", ", F.sort_array(F.collect_list(UNIT)).cast("array<string>")))
    return F.concat(F.lit("["), listed.scalar(), F.lit("]..."))


def quality_report(df: DataFrame, expected: list[str] = RAW_COLUMNS) -> DataFrame:
    """All checks in order as ``(position, name, passed, detail)``."""
    missing, extra = column_issues(df, expected)
    kinds = type_issues(df)
    column_detail = (
        f"Missing columns: {quote(missing)}" if missing
        else f"Extra columns (ok): {quote(extra)}" if extra
        else ""
    )
    nulls = _null_total(df)
    null_names = _names_where({c: F.col(f"`null:{c}`") > 0 for c in df.columns})
    issues = {
        "unit_id contains values < 1": F.col("lowest_unit") < 1,
        "time_cycles contains values < 1": F.col("lowest_cycle") < 1,
    }
    for c in _sensors(df):
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            issues[f"{c} contains infinite values"] = F.col(f"`inf:{c}`") > 0
    range_issues = _names_where(issues)
    checks: list[tuple[str, Column, Column]] = [
        ("columns_present", F.lit(not missing), F.lit(column_detail)),
        (
            "no_nulls",
            nulls == 0,
            F.concat(nulls.cast("string"), F.lit(" nulls in columns: "), _quoted(null_names)),
        ),
        (
            "no_duplicates",
            F.col("in_duplicates") == 0,
            F.concat(
                F.col("in_duplicates").cast("string"),
                F.lit(" duplicate (unit_id, time_cycles) rows"),
            ),
        ),
        ("column_types", F.lit(not kinds), F.lit("; ".join(kinds))),
        ("value_ranges", F.size(range_issues) == 0, F.concat_ws("; ", range_issues)),
        (
            "temporal_continuity",
            F.col("gap_units") == 0,
            F.concat(
                F.col("gap_units").cast("string"),
                F.lit(" units have cycle gaps: "),
                _first_gap_units(df),
            ),
        ),
    ]
    if "rul" in df.columns:
        checks.append(
            (
                "rul_non_negative",
                F.col("negative_rul") == 0,
                F.lit("RUL contains negative values"),
            )
        )
    if "is_anomaly" in df.columns:
        checks.append(
            (
                "anomaly_binary",
                F.col("not_binary") == 0,
                F.concat(F.col("not_binary").cast("string"), F.lit(" values outside 0 and 1")),
            )
        )
    checks.append(
        (
            "schema_validation",
            F.col("bad_rows") == 0,
            F.concat(
                F.col("bad_rows").cast("string"),
                F.lit("/"),
                F.col("total_rows").cast("string"),
                F.lit(" rows failed"),
            ),
        )
    )
    always = {"columns_present"}
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("name"),
            passed.alias("passed"),
            (detail if name in always else F.when(passed, F.lit("")).otherwise(detail)).alias(
                "detail"
            ),
        )
        for i, (name, passed, detail) in enumerate(checks)
    ]
    return _facts(df).select(F.inline(F.array(*rows)))


def overall(report: DataFrame) -> DataFrame:
    return report.agg(
        F.every("passed").alias("passed"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
    )
