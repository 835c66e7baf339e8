"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison across engines; sums differ in the last bits."""
    return F.round(c, digits) + F.lit(0.0)


def rounded_all(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(
        *[
            rounded(c, special.get(c, digits)).alias(c) if kinds[c] == "double" else F.col(c)
            for c in df.columns
        ]
    )


USER_PANEL = """
user_panel AS (
  SELECT *, CAST(rul < 30 AS INTEGER) AS is_anomaly FROM (
    SELECT user_id AS unit_id, event_id, ts, value + 0.0 AS sensor_2,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS time_cycles,
           count(*) OVER (PARTITION BY user_id)
             - row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rul
    FROM events) numbered)
"""

SUPPLIER_PANEL = """
supplier_panel AS (
  SELECT *, CAST(rul < 30 AS INTEGER) AS is_anomaly FROM (
    SELECT l_suppkey AS unit_id, l_quantity + 0.0 AS sensor_2, l_extendedprice + 0.0 AS sensor_3,
           l_discount + 0.0 AS sensor_4, l_tax + 0.0 AS sensor_7,
           row_number() OVER line AS time_cycles,
           count(*) OVER (PARTITION BY l_suppkey) - row_number() OVER line AS rul
    FROM lineitem
    WINDOW line AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber,
                    l_partkey, l_extendedprice)) numbered)
"""

ORDER_PANEL = """
order_panel AS (
  SELECT l_orderkey AS unit_id, CAST(l_linenumber AS BIGINT) AS time_cycles,
         CASE WHEN l_quantity <> 0 THEN l_quantity END AS sensor_2,
         CASE WHEN l_extendedprice <> 0 THEN l_extendedprice END AS sensor_3,
         CASE WHEN l_discount <> 0 THEN l_discount END AS sensor_4,
         CASE WHEN l_tax <> 0 THEN l_tax END AS sensor_7,
         CASE WHEN l_tax <> 0 THEN l_extendedprice / l_tax
              ELSE CAST('Infinity' AS DOUBLE) END AS sensor_8,
         CAST(4 - l_linenumber AS BIGINT) AS rul,
         CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END AS is_anomaly
  FROM lineitem)
"""

VECTOR_COLUMNS = ["op_setting_1", "op_setting_2", "op_setting_3"] + [
    f"sensor_{i}" for i in range(1, 22)
]
#: Places of a vector's numbers that a column sums: all 64 are read, each by one column.
VECTOR_PLACES = {c: range(i, 64, len(VECTOR_COLUMNS)) for i, c in enumerate(VECTOR_COLUMNS)}


def _vector_sql(places: range) -> str:
    return " + ".join(f"CAST(embedding[{j + 1}] AS DOUBLE)" for j in places)


VECTOR_PANEL = (
    "vector_panel AS (SELECT CAST(label + 1 AS BIGINT) AS unit_id, "
    "row_number() OVER (PARTITION BY label ORDER BY vec_id) AS time_cycles, "
    + ", ".join(f"round({_vector_sql(p)}, 4) + 0.0 AS {c}" for c, p in VECTOR_PLACES.items())
    + " FROM embeddings)"
)

SCORES = """
scores AS (
  SELECT event_id, value / 600 AS score, CAST(event_type = 'error' AS INTEGER) AS label
  FROM events)
"""

READINGS = """
readings AS (
  SELECT format('engine_{:03d}', user_id) AS engine_id,
         format('engine_{:03d}', user_id) AS sensor_id, event_id, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle,
         CAST(70 AS BIGINT) AS max_cycle, value / 600 AS anomaly_score,
         value / 600 > 0.2 AS is_anomaly,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS processing_time_ms,
         event_type || ':local' AS model_version
  FROM events),
live AS (SELECT * FROM readings WHERE cycle <= max_cycle)
"""

DRIFT_PAIR = """
stacked AS (
  SELECT 0 AS side, l_quantity + 0.0 AS sensor_2, l_extendedprice + 0.0 AS sensor_3,
         l_discount + 0.0 AS sensor_4, l_tax + 0.0 AS sensor_7
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-17'
  UNION ALL
  SELECT 1, (l_quantity + 0.0) * 1.25, l_extendedprice + 0.0, l_discount + 0.0,
         (l_tax + 0.0) + 0.01
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-17'),
long AS (
  SELECT side, 'sensor_2' AS feature, sensor_2 AS v FROM stacked
  UNION ALL SELECT side, 'sensor_3', sensor_3 FROM stacked
  UNION ALL SELECT side, 'sensor_4', sensor_4 FROM stacked
  UNION ALL SELECT side, 'sensor_7', sensor_7 FROM stacked),
ecdf AS (
  SELECT feature, v,
         sum(r) OVER upto / sum(r) OVER (PARTITION BY feature) AS ref_cdf,
         sum(c) OVER upto / sum(c) OVER (PARTITION BY feature) AS cur_cdf,
         CAST(sum(r) OVER (PARTITION BY feature) AS BIGINT) AS n_reference,
         CAST(sum(c) OVER (PARTITION BY feature) AS BIGINT) AS n_current,
         lead(v) OVER (PARTITION BY feature ORDER BY v) AS next_v
  FROM (SELECT feature, v, CAST(count(*) FILTER (WHERE side = 0) AS DOUBLE) AS r,
               CAST(count(*) FILTER (WHERE side = 1) AS DOUBLE) AS c
        FROM long GROUP BY feature, v) counted
  WINDOW upto AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
ks AS (
  SELECT feature, max(abs(ref_cdf - cur_cdf)) AS statistic, any_value(n_reference) AS n_reference,
         any_value(n_current) AS n_current
  FROM ecdf GROUP BY feature),
tested AS (
  SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(
           range(1, 101),
           lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * x * x)
         )), 0.0), 1.0) END AS p_value
  FROM (SELECT *, (sqrt(n_reference * n_current / (n_reference + n_current)) + 0.12
               + 0.11 / sqrt(n_reference * n_current / (n_reference + n_current))) * statistic AS x
        FROM ks) scaled)
"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + "\n" + select.strip()
