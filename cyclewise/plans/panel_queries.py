"""Registered queries: scans, panels, splits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, RAW_COLUMNS, UNIT
from cyclewise.operators import panel, split
from cyclewise.operators.features import drop_sensors
from cyclewise.operators.unit_order import Layout, number_rows
from cyclewise.plans import fixtures
from cyclewise.plans.registry import (
    SUPPLIER_PANEL,
    USER_PANEL,
    VECTOR_PANEL,
    query,
    rounded,
    rounded_all,
    with_,
)
from cyclewise.session import shared_dir
from cyclewise.sources.panel_text import read_panel
from cyclewise.sources.tables import read_table


@query(
    """SELECT l_returnflag, count(*) AS n_rows, round(sum(l_quantity), 2) + 0.0 AS sum_quantity,
    CAST(max(epoch_us(l_shipdate)) AS BIGINT) AS last_ship_us FROM lineitem GROUP BY l_returnflag"""
)
def parquet_scan(spark, sf_dir):
    return (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            rounded(F.sum("l_quantity"), 2).alias("sum_quantity"),
            F.max(F.unix_micros("l_shipdate")).alias("last_ship_us"),
        )
    )


@query(with_(VECTOR_PANEL, select="SELECT * FROM vector_panel"))
def text_panel_scan(spark, sf_dir):
    """The panel written as blank-separated text and read back."""
    path = f"{shared_dir(spark)}/panel-{uuid.uuid4().hex}"
    line = F.concat_ws("  ", *[F.col(c).cast("string") for c in RAW_COLUMNS])
    fixtures.vector_panel(spark, sf_dir)[0].select(line.alias("value")).write.text(path)
    return rounded_all(read_panel(spark, path), 4)


@query(
    with_(USER_PANEL, select="SELECT unit_id, event_id, time_cycles, rul FROM user_panel"),
)
def numbered_rows(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").withColumnRenamed("user_id", UNIT)
    layout = Layout.measured(events)
    return number_rows(events, ["ts", "event_id"], remaining="rul", layout=layout).select(
        UNIT, "event_id", CYCLE, "rul"
    )


@query(
    with_(
        USER_PANEL,
        select="""SELECT unit_id, time_cycles,
        max(time_cycles) OVER (PARTITION BY unit_id) - time_cycles AS rul,
        CAST(max(time_cycles) OVER (PARTITION BY unit_id) - time_cycles < 30 AS INTEGER)
          AS is_anomaly FROM user_panel""",
    )
)
def panel_rul_label(spark, sf_dir):
    rows, layout = fixtures.user_panel(spark, sf_dir)
    return panel.label_anomalies(panel.compute_rul(rows.select(UNIT, CYCLE), layout))


@query(
    with_(
        USER_PANEL,
        select="""SELECT unit_id, time_cycles, strftime(TIMESTAMP '2024-01-01'
        + to_hours(unit_id - 1) + to_seconds(time_cycles - 1), '%Y-%m-%d %H:%M:%S') AS event_time
        FROM user_panel""",
    )
)
def simulated_time(spark, sf_dir):
    rows, layout = fixtures.user_panel(spark, sf_dir)
    return panel.add_simulated_timestamps(rows.select(UNIT, CYCLE), layout=layout).select(
        UNIT, CYCLE, F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time")
    )


@query(
    with_(
        SUPPLIER_PANEL,
        select="""SELECT unit_id, time_cycles, round(sensor_2, 2) AS sensor_2,
        round(sensor_3, 2) AS sensor_3, round(sensor_4, 2) AS sensor_4,
        round(sensor_7, 2) AS sensor_7, rul, is_anomaly,
        CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT) + (unit_id - 1) * 3600 + time_cycles - 1
          AS event_second FROM supplier_panel""",
    )
)
def panel_ingest(spark, sf_dir):
    """Numbering gives order, remaining life and event time from one shuffle."""
    frame = panel.add_simulated_timestamps(
        fixtures.supplier_panel(spark, sf_dir)[0], index=F.col(CYCLE) - 1
    )
    return rounded_all(
        frame.withColumn("event_second", F.unix_timestamp("timestamp")).drop("timestamp"), 2
    )


@query(
    with_(
        USER_PANEL,
        select="""SELECT unit_id, CAST(epoch_us(max(ts)) AS BIGINT) AS last_us,
        max(time_cycles) AS max_cycle, count(*) AS n_rows FROM user_panel GROUP BY unit_id""",
    )
)
def unit_lengths(spark, sf_dir):
    rows = fixtures.user_panel(spark, sf_dir)[0]
    last = rows.groupBy(UNIT).agg(F.unix_micros(F.max("ts")).alias("last_us"))
    return panel.unit_lengths(rows).join(last, UNIT).select(UNIT, "last_us", "max_cycle", "n_rows")


@query("SELECT count(DISTINCT user_id) AS num_units, count(*) AS total_rows FROM events")
def unit_counts(spark, sf_dir):
    return panel.unit_count(read_table(spark, sf_dir, "events").withColumnRenamed("user_id", UNIT))


@query(
    with_(
        USER_PANEL,
        select="""SELECT count(*) AS n_rows, CAST(sum(is_anomaly) AS BIGINT) AS n_anomaly,
        round(avg(is_anomaly), 6) + 0.0 AS anomaly_rate FROM user_panel""",
    )
)
def class_balance(spark, sf_dir):
    return rounded_all(panel.class_balance(fixtures.user_panel(spark, sf_dir)[0]))


@query(
    with_(
        VECTOR_PANEL,
        select="""SELECT * EXCLUDE (sensor_1, sensor_5, sensor_6, sensor_10, sensor_16,
        sensor_18, sensor_19) FROM vector_panel""",
    ),
    name="drop_sensors",
)
def drop_flat_sensors(spark, sf_dir):
    return drop_sensors(fixtures.vector_panel(spark, sf_dir)[0])


@query(
    with_(
        VECTOR_PANEL,
        "lives AS (SELECT unit_id, 10 * unit_id AS rul_last FROM vector_panel GROUP BY unit_id)",
        select="""SELECT v.unit_id, v.time_cycles,
        rul_last + max(time_cycles) OVER (PARTITION BY v.unit_id) - time_cycles AS rul,
        CAST(rul_last + max(time_cycles) OVER (PARTITION BY v.unit_id) - time_cycles < 30
          AS INTEGER) AS is_anomaly FROM vector_panel v JOIN lives l ON v.unit_id = l.unit_id""",
    )
)
def test_panel_labels(spark, sf_dir):
    """Units cut off before failure, with their known remaining life."""
    vectors, layout = fixtures.vector_panel(spark, sf_dir)
    rows = vectors.select(UNIT, CYCLE)
    lives = (
        read_table(spark, sf_dir, "embeddings")
        .select((F.col("label") + 1).cast("long").alias(UNIT))
        .distinct()
        .withColumn("rul_last", F.col(UNIT) * 10)
    )
    return panel.label_test_panel(rows, lives, layout=layout)


SPLIT_SQL = """
units AS (SELECT DISTINCT user_id AS unit_id FROM events),
ranked AS (SELECT unit_id, row_number() OVER (ORDER BY md5(unit_id || ':42')) AS r,
                  count(*) OVER () AS n FROM units),
cuts AS (SELECT *, CAST(floor(n * 0.8) AS INTEGER) AS test_start FROM ranked),
sizes AS (SELECT *, CAST(floor(test_start * 0.875) AS INTEGER) AS val_start FROM cuts),
unit_split AS (SELECT unit_id, CASE WHEN r <= val_start THEN 'train'
                 WHEN r <= test_start THEN 'val' ELSE 'test' END AS split FROM sizes)
"""


@query(with_(SPLIT_SQL, select="SELECT unit_id, split FROM unit_split"))
def unit_split(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").withColumnRenamed("user_id", UNIT)
    return split.unit_split(events)


@query(
    with_(
        SPLIT_SQL,
        select="""SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_units,
        round(sum(value), 2) + 0.0 AS sum_value
        FROM events JOIN unit_split ON user_id = unit_id GROUP BY split""",
    )
)
def split_rows(spark, sf_dir):
    """Rows tagged by hash comparison, without a join."""
    events = read_table(spark, sf_dir, "events").withColumnRenamed("user_id", UNIT)
    return (
        split.with_split(events)
        .groupBy("split", UNIT)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
        .groupBy("split")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(UNIT).alias("n_units"),
            rounded(F.sum("v"), 2).alias("sum_value"),
        )
    )


@query(
    with_(
        SPLIT_SQL,
        select="""SELECT 'train_test' AS pair, count(*) AS shared FROM (
          SELECT unit_id FROM unit_split WHERE split = 'train' INTERSECT
          SELECT unit_id FROM unit_split WHERE split = 'test') a
        UNION ALL SELECT 'train_val', count(*) FROM (
          SELECT unit_id FROM unit_split WHERE split = 'train' INTERSECT
          SELECT unit_id FROM unit_split WHERE split = 'val') b
        UNION ALL SELECT 'all_minus_splits', count(*) FROM (
          SELECT DISTINCT user_id AS unit_id FROM events EXCEPT
          SELECT unit_id FROM unit_split) c""",
    )
)
def value_set_ops(spark, sf_dir):
    """Splits are disjoint and lossless."""
    events = read_table(spark, sf_dir, "events").withColumnRenamed("user_id", UNIT)
    units = split.unit_split(events)

    def part(name):
        return units.filter(F.col("split") == name).select(UNIT)

    def sized(name, rows):
        return rows.agg(F.count(F.lit(1)).alias("shared")).select(
            F.lit(name).alias("pair"), "shared"
        )

    return (
        sized("train_test", part("train").intersect(part("test")))
        .unionByName(sized("train_val", part("train").intersect(part("val"))))
        .unionByName(
            sized("all_minus_splits", events.select(UNIT).subtract(units.select(UNIT)))
        )
    )


@query(
    with_(
        USER_PANEL,
        select="""SELECT unit_id, time_cycles, sensor_2, rul FROM user_panel
        ORDER BY unit_id, time_cycles LIMIT 5""",
    )
)
def panel_preview(spark, sf_dir):
    rows = fixtures.user_panel(spark, sf_dir)[0]
    return rows.select(UNIT, CYCLE, "sensor_2", "rul").orderBy(UNIT, CYCLE).limit(5)
