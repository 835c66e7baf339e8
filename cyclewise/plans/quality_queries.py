"""Registered queries: data quality, row and request contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, UNIT
from cyclewise.functions.contracts import REASONS, request_reasons
from cyclewise.operators import quality
from cyclewise.operators.unit_order import Layout
from cyclewise.plans import fixtures
from cyclewise.plans.registry import ORDER_PANEL, SQL, query, rounded_all, with_
from cyclewise.sources.tables import read_table

_COLUMNS = [
    "unit_id",
    "time_cycles",
    "sensor_2",
    "sensor_3",
    "sensor_4",
    "sensor_7",
    "sensor_8",
    "rul",
    "is_anomaly",
]


@query(
    with_(
        ORDER_PANEL,
        select=" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null "
            "FROM order_panel"
            for c in _COLUMNS
        ),
    )
)
def quality_nulls(spark, sf_dir):
    return quality.null_counts(fixtures.order_panel(spark, sf_dir))


@query(
    with_(
        ORDER_PANEL,
        select="""SELECT unit_id, time_cycles, count(*) AS n_rows FROM order_panel
        GROUP BY unit_id, time_cycles HAVING count(*) > 1""",
    )
)
def quality_duplicates(spark, sf_dir):
    return quality.duplicate_keys(fixtures.order_panel(spark, sf_dir))


@query(
    with_(
        ORDER_PANEL,
        select="""SELECT max(unit_id < 1) AS unit_below_1, max(time_cycles < 1) AS cycle_below_1,
        max(isinf(sensor_2)) AS inf_sensor_2, max(isinf(sensor_3)) AS inf_sensor_3,
        max(coalesce(isinf(sensor_4), false)) AS inf_sensor_4,
        max(coalesce(isinf(sensor_7), false)) AS inf_sensor_7, max(isinf(sensor_8)) AS inf_sensor_8
        FROM order_panel""",
    )
)
def quality_ranges(spark, sf_dir):
    return quality.range_flags(fixtures.order_panel(spark, sf_dir))


@query(
    with_(
        ORDER_PANEL,
        select="""SELECT unit_id, count(*) AS n_rows, min(time_cycles) AS first_cycle,
        max(time_cycles) AS last_cycle, count(*) <> max(time_cycles) - min(time_cycles) + 1
        AS has_gap FROM order_panel GROUP BY unit_id""",
    )
)
def quality_continuity(spark, sf_dir):
    return quality.unit_continuity(fixtures.order_panel(spark, sf_dir))


@query(
    with_(
        ORDER_PANEL,
        select="""SELECT count(*) FILTER (WHERE rul < 0) AS negative_rul,
        count(*) FILTER (WHERE is_anomaly NOT IN (0, 1)) AS not_binary FROM order_panel""",
    )
)
def quality_labels(spark, sf_dir):
    return quality.label_flags(fixtures.order_panel(spark, sf_dir))


@query(
    with_(
        ORDER_PANEL,
        select="""SELECT * FROM (SELECT unit_id, time_cycles, lag(time_cycles)
        OVER (PARTITION BY unit_id ORDER BY time_cycles) AS previous_cycle FROM order_panel) p
        WHERE time_cycles - previous_cycle > 1""",
    )
)
def gap_rows(spark, sf_dir):
    rows = fixtures.order_panel(spark, sf_dir)
    return quality.gap_rows(rows, Layout.measured(rows))


_STATS = """
per_unit AS (SELECT unit_id, max(time_cycles) AS m FROM order_panel GROUP BY unit_id),
keys AS (SELECT unit_id, time_cycles, count(*) AS copies FROM order_panel GROUP BY ALL),
nulls AS (SELECT CAST(sum((sensor_4 IS NULL)::INT + (sensor_7 IS NULL)::INT) AS BIGINT) AS n
          FROM order_panel)
"""


@query(
    with_(
        ORDER_PANEL,
        _STATS,
        select="""SELECT count(*) AS total_rows, count(DISTINCT unit_id) AS num_units,
        9 AS num_columns, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
        round(avg(is_anomaly), 6) + 0.0 AS anomaly_rate,
        (SELECT min(m) FROM per_unit) AS min_cycles_per_unit,
        (SELECT max(m) FROM per_unit) AS max_cycles_per_unit,
        round((SELECT avg(m) FROM per_unit), 6) + 0.0 AS avg_cycles_per_unit,
        (SELECT n FROM nulls) AS null_count,
        count(*) - (SELECT count(*) FROM keys) AS duplicate_count FROM order_panel""",
    )
)
def dataset_stats(spark, sf_dir):
    return rounded_all(quality.dataset_stats(fixtures.order_panel(spark, sf_dir)))


_CONTRACT = """
judged AS (SELECT *, list_filter([
  CASE WHEN unit_id < 1 THEN 'unit_id below 1' END,
  CASE WHEN sensor_4 IS NULL THEN 'sensor_4 missing' END,
  CASE WHEN sensor_7 IS NULL THEN 'sensor_7 missing' END], lambda r: r IS NOT NULL) AS reasons
  FROM order_panel)
"""


@query(
    with_(
        ORDER_PANEL,
        _CONTRACT,
        select="""SELECT unit_id, time_cycles, array_to_string(reasons, '; ') AS reasons
        FROM judged WHERE len(reasons) > 0""",
    )
)
def row_contract(spark, sf_dir):
    bad = quality.contract_violations(fixtures.order_panel(spark, sf_dir))
    return bad.select(UNIT, CYCLE, F.concat_ws("; ", REASONS).alias("reasons"))


@query(
    with_(
        ORDER_PANEL,
        "numbered AS (SELECT * FROM (SELECT user_id AS unit_id, event_id AS time_cycles, "
        "CASE WHEN value >= 1 THEN value END AS sensor_2 FROM events) e "
        "ORDER BY md5(unit_id || ':' || time_cycles || ':42'), unit_id, time_cycles LIMIT 100)",
        select="""SELECT count(*) AS n_sampled, count(*) FILTER (WHERE unit_id < 1 OR
        time_cycles < 1 OR sensor_2 IS NULL) AS n_failed FROM numbered""",
    )
)
def contract_sample(spark, sf_dir):
    """The sampling check: 100 rows by hash of key and seed, then the row contract."""
    rows = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias(UNIT),
        F.col("event_id").alias(CYCLE),
        F.when(F.col("value") >= 1, F.col("value")).alias("sensor_2"),
    )
    return quality.check_sample(rows, 100)


_UNITS = """
per_unit AS (SELECT unit_id, count(*) AS n, min(time_cycles) AS lo, max(time_cycles) AS hi
             FROM order_panel GROUP BY unit_id),
gaps AS (SELECT unit_id FROM per_unit WHERE n <> hi - lo + 1),
shown AS (SELECT string_agg(unit_id, ', ' ORDER BY unit_id) AS s
          FROM (SELECT unit_id FROM gaps ORDER BY unit_id LIMIT 5) g),
facts AS (SELECT count(*) AS n_rows,
  CAST(sum((sensor_4 IS NULL)::INT + (sensor_7 IS NULL)::INT) AS BIGINT) AS nulls,
  count(*) FILTER (WHERE is_anomaly NOT IN (0, 1)) AS not_binary,
  count(*) FILTER (WHERE unit_id < 1 OR sensor_4 IS NULL OR sensor_7 IS NULL) AS bad_rows,
  (SELECT CAST(sum(c) AS BIGINT) FROM (SELECT count(*) AS c FROM order_panel
     GROUP BY unit_id, time_cycles HAVING count(*) > 1) d) AS dup FROM order_panel)
"""


@query(
    with_(
        ORDER_PANEL,
        _UNITS,
        select="""
SELECT 0 AS position, 'columns_present' AS name, true AS passed,
       'Extra columns (ok): [''sensor_8'']' AS detail
UNION ALL SELECT 1, 'no_nulls', nulls = 0,
       nulls || ' nulls in columns: [''sensor_4'', ''sensor_7'']' FROM facts
UNION ALL SELECT 2, 'no_duplicates', dup = 0,
       dup || ' duplicate (unit_id, time_cycles) rows' FROM facts
UNION ALL SELECT 3, 'column_types', true, ''
UNION ALL SELECT 4, 'value_ranges', false,
       'unit_id contains values < 1; sensor_8 contains infinite values'
UNION ALL SELECT 5, 'temporal_continuity', false,
       (SELECT count(*) FROM gaps) || ' units have cycle gaps: [' || s || ']...' FROM shown
UNION ALL SELECT 6, 'rul_non_negative', false, 'RUL contains negative values'
UNION ALL SELECT 7, 'anomaly_binary', not_binary = 0, not_binary || ' values outside 0 and 1'
       FROM facts
UNION ALL SELECT 8, 'schema_validation', bad_rows = 0, bad_rows || '/' || n_rows || ' rows failed'
       FROM facts""",
    )
)
def quality_report(spark, sf_dir):
    expected = ["unit_id", "time_cycles", "sensor_2", "sensor_3", "sensor_4", "sensor_7"]
    return quality.quality_report(fixtures.order_panel(spark, sf_dir), expected)


@query(
    f"""SELECT bool_and(passed) AS passed, count(*) AS n_checks, count(*) FILTER (WHERE NOT passed) AS n_failed
    FROM ({SQL['quality_report']}) AS report"""
)
def quality_overall(spark, sf_dir):
    return quality.overall(quality_report(spark, sf_dir))


@query(
    """SELECT vec_id, CASE label WHEN 1 THEN 'sensor_id length' WHEN 2 THEN 'sensor_id length'
    WHEN 3 THEN 'window empty' WHEN 4 THEN 'step empty' WHEN 5 THEN 'window ragged'
    WHEN 6 THEN 'value not finite' WHEN 7 THEN 'timestamp missing' ELSE '' END AS reasons
    FROM embeddings"""
)
def request_validation(spark, sf_dir):
    rows = fixtures.requests(spark, sf_dir)
    why = request_reasons(F.col("sensor_id"), F.col("window"), F.col("timestamp"))
    return rows.select("vec_id", F.concat_ws("; ", why).alias("reasons"))
