"""Quality checks that ride along with a write.

``watch`` attaches the value checks and counters of a panel to it as an observation: Spark
collects them while the job that writes the rows runs, so the panel is not read again for
its report. What needs a neighbour (repeated keys, gaps) follows from the previous cycle of
the unit, which the numbering of the panel's rows brings along in the same sort.

``report`` gives the checks as ``(position, name, passed, detail)`` after the write. The
names are those of the full report where the rule is the same. ``cycle_gaps`` and
``repeated_keys`` count rows: rows behind a gap, and every copy after the first.

Defined results: a panel without rows passes every check and counts 0; missing key values
count as nulls and take no part in gaps and repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.constants import CYCLE, RAW_COLUMNS, UNIT
from cyclewise.functions.contracts import reading_reasons
from cyclewise.functions.numeric import is_infinite, is_missing
from cyclewise.operators import quality
from cyclewise.operators.unit_order import SPLIT, Layout, previous_value

_PREVIOUS = "_previous_cycle"


def watch(df: DataFrame, layout: Layout = SPLIT, name: str = "panel checks") -> tuple[DataFrame, Observation]:
    """The panel, and the observation that its next action fills."""
    placed = previous_value(df, CYCLE, _PREVIOUS, layout=layout)
    step = F.col(CYCLE) - F.col(_PREVIOUS)
    counters = {
        "rows": F.count(F.lit(1)),
        "units": F.count_if(F.col(_PREVIOUS).isNull() & F.col(CYCLE).isNotNull()),
        "repeated_keys": F.count_if(step == 0),
        "cycle_gaps": F.count_if(step > 1),
        "low_unit": F.count_if(F.col(UNIT) < 1),
        "low_cycle": F.count_if(F.col(CYCLE) < 1),
        "bad_rows": F.count_if(F.size(reading_reasons(df.columns)) > 0),
    }
    for field in df.schema.fields:
        number = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        missing = is_missing(F.col(field.name)) if number else F.col(field.name).isNull()
        counters[f"null:{field.name}"] = F.count_if(missing)
        if number and field.name.startswith("sensor_"):
            counters[f"inf:{field.name}"] = F.count_if(is_infinite(F.col(field.name)))
    if "rul" in df.columns:
        counters["negative_rul"] = F.count_if(F.col("rul") < 0)
    if "is_anomaly" in df.columns:
        counters["anomalies"] = F.count_if(F.col("is_anomaly") == 1)
        counters["not_binary"] = F.count_if(~F.coalesce(F.col("is_anomaly").isin(0, 1), F.lit(False)))
    seen = Observation(name)
    watched = placed.observe(seen, *[F.coalesce(c, F.lit(0)).alias(n) for n, c in counters.items()])
    return watched.drop(_PREVIOUS), seen


def report(
    spark: SparkSession, seen: Observation, df: DataFrame, expected: list[str] = RAW_COLUMNS
) -> DataFrame:
    """The checks of a watched panel; a few rows, made from the observed counters."""
    found = seen.get
    missing, extra = quality.column_issues(df, expected)
    kinds = quality.type_issues(df)
    nulls = {k[5:]: n for k, n in found.items() if k.startswith("null:") and n}
    infinite = [k[4:] for k, n in found.items() if k.startswith("inf:") and n]
    ranges = [f"{n} contains values < 1" for n, k in ((UNIT, "low_unit"), (CYCLE, "low_cycle")) if found[k]]
    ranges += [f"{n} contains infinite values" for n in infinite]
    checks = [
        ("columns_present", not missing, f"Missing columns: {quality.quote(missing)}" if missing
         else f"Extra columns (ok): {quality.quote(extra)}" if extra else ""),
        ("no_nulls", not nulls, f"{sum(nulls.values())} nulls in columns: {quality.quote(list(nulls))}"),
        ("repeated_keys", not found["repeated_keys"], f"{found['repeated_keys']} repeated rows"),
        ("column_types", not kinds, "; ".join(kinds)),
        ("value_ranges", not ranges, "; ".join(ranges)),
        ("cycle_gaps", not found["cycle_gaps"], f"{found['cycle_gaps']} rows behind a gap"),
    ]
    if "negative_rul" in found:
        checks.append(("rul_non_negative", not found["negative_rul"], f"{found['negative_rul']} negative values"))
    if "not_binary" in found:
        checks.append(("anomaly_binary", not found["not_binary"], f"{found['not_binary']} values outside 0 and 1"))
    checks.append(("schema_validation", not found["bad_rows"], f"{found['bad_rows']}/{found['rows']} rows failed"))
    rows = [
        (i, name, passed, detail if name == "columns_present" or not passed else "")
        for i, (name, passed, detail) in enumerate(checks)
    ]
    return spark.createDataFrame(rows, "position int, name string, passed boolean, detail string")
