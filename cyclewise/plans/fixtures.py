"""Sensor panels and scored sets that the registered queries derive from the tables."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, OP_SETTINGS, SENSORS, UNIT
from cyclewise.functions.decisions import engine_name
from cyclewise.operators.panel import label_anomalies
from cyclewise.operators.unit_order import Layout, number_rows
from cyclewise.plans.registry import VECTOR_PLACES
from cyclewise.sources.tables import read_table

SUPPLIER_SENSORS = {
    "sensor_2": "l_quantity",
    "sensor_3": "l_extendedprice",
    "sensor_4": "l_discount",
    "sensor_7": "l_tax",
}
SUPPLIER_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
DRIFT_DATE = "1998-06-17"
DESIGN_LIFE = 70
ALARM = 0.2


def _plain(name: str) -> Column:
    """Without negative zeros, which print differently from zeros."""
    return F.col(name) + F.lit(0.0)


def user_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """One channel per user; the cycle is the row number in event time."""
    readings = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias(UNIT), "event_id", "ts", _plain("value").alias("sensor_2")
    )
    layout = Layout.measured(readings)
    numbered = number_rows(readings, ["ts", "event_id"], remaining="rul", layout=layout)
    return label_anomalies(numbered), layout


def user_readings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """The user panel with the columns of a labeled panel only."""
    panel, layout = user_panel(spark, sf_dir)
    return panel.select(UNIT, CYCLE, "sensor_2", "rul", "is_anomaly"), layout


def supplier_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """Four channels per supplier, ordered by ship date."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias(UNIT),
        *SUPPLIER_ORDER,
        *[_plain(source).alias(name) for name, source in SUPPLIER_SENSORS.items()],
    )
    layout = Layout.measured(lines)
    numbered = number_rows(lines, SUPPLIER_ORDER, remaining="rul", layout=layout)
    return label_anomalies(numbered.select(UNIT, CYCLE, *SUPPLIER_SENSORS, "rul")), layout


def order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as they are: repeated keys, gaps, and zero tax or discount as missing."""
    zero_is_missing = {
        name: F.when(F.col(source) != 0, F.col(source))
        for name, source in SUPPLIER_SENSORS.items()
    }
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(UNIT),
        F.col("l_linenumber").cast("long").alias(CYCLE),
        *[c.alias(n) for n, c in zero_is_missing.items()],
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice") / F.col("l_tax"))
        .otherwise(F.lit(float("inf")))
        .alias("sensor_8"),
        (F.lit(4) - F.col("l_linenumber")).cast("long").alias("rul"),
        F.when(F.col("l_returnflag") == "R", 2)
        .when(F.col("l_returnflag") == "A", 1)
        .otherwise(0)
        .alias("is_anomaly"),
    )


def vector_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    """All 26 columns from the 64 numbers of every vector; one unit per label."""
    vectors = read_table(spark, sf_dir, "embeddings")
    values = []
    for places in VECTOR_PLACES.values():
        numbers = [F.get("embedding", F.lit(j)).cast("double") for j in places]
        values.append(F.round(reduce(add, numbers), 4) + F.lit(0.0))
    readings = vectors.select(
        (F.col("label") + 1).cast("long").alias(UNIT),
        "vec_id",
        *[v.alias(n) for v, n in zip(values, [*OP_SETTINGS, *SENSORS])],
    )
    layout = Layout.measured(readings)
    numbered = number_rows(readings, ["vec_id"], layout=layout)
    return numbered.select(UNIT, CYCLE, *OP_SETTINGS, *SENSORS), layout


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order lines before and from a ship date on, two of the four channels shifted."""
    late = F.col("l_shipdate") >= F.lit(DRIFT_DATE).cast("timestamp_ntz")
    channels = [_plain(source).alias(name) for name, source in SUPPLIER_SENSORS.items()]
    reference = read_table(spark, sf_dir, "lineitem", ~late).select(*channels)
    current = read_table(spark, sf_dir, "lineitem", late).select(*channels)
    return reference, current.withColumn("sensor_2", F.col("sensor_2") * 1.25).withColumn(
        "sensor_7", F.col("sensor_7") + 0.01
    )


def score_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") / 600).alias("score"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


def scored_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored readings of a fleet: some engines pass their design life, some do not."""
    events = read_table(spark, sf_dir, "events").withColumnRenamed("user_id", UNIT)
    numbered = number_rows(
        events, ["ts", "event_id"], position="cycle", layout=Layout.measured(events)
    )
    return numbered.select(
        engine_name(F.col(UNIT)).alias("engine_id"),
        engine_name(F.col(UNIT)).alias("sensor_id"),
        "event_id",
        "ts",
        "cycle",
        F.lit(DESIGN_LIFE).cast("long").alias("max_cycle"),
        (F.col("value") / 600).alias("anomaly_score"),
        (F.col("value") / 600 > ALARM).alias("is_anomaly"),
        F.get_json_object("props", "$.k").cast("double").alias("processing_time_ms"),
        F.concat("event_type", F.lit(":local")).alias("model_version"),
    )


def fleet_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(
        engine_name(F.col("c_custkey")).alias("engine_id")
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection requests of 8 x 8 values; some labels stand for a kind of bad request."""
    return requests_of(read_table(spark, sf_dir, "embeddings"))


def requests_of(vectors: DataFrame) -> DataFrame:
    values = F.transform("embedding", lambda v: v.cast("double"))
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(values, i * 8 + 1, F.lit(8))
    )
    short_last = F.concat(F.slice(steps, 1, 7), F.array(F.slice(values, 57, 3)))
    no_number = F.concat(
        F.slice(steps, 1, 7), F.array(F.array_repeat(F.lit(float("nan")), 8))
    )
    label = F.col("label")
    empty = F.array().cast("array<array<double>>")
    return vectors.select(
        "vec_id",
        F.when(label == 1, "")
        .when(label == 2, F.repeat(F.lit("x"), 65))
        .otherwise(F.format_string("engine_%03d", "vec_id"))
        .alias("sensor_id"),
        F.when(label == 3, empty)
        .when(label == 4, F.array(F.array().cast("array<double>")))
        .when(label == 5, short_last)
        .when(label == 6, no_number)
        .otherwise(steps)
        .alias("window"),
        F.when(label != 7, F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id"))).alias(
            "timestamp"
        ),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a run of the model named like its type."""
    value = F.col("value") / 600
    known = F.create_map(F.lit("test_f1"), value, F.lit("test_precision"), value / 2)
    more = F.map_concat(known, F.create_map(F.lit("test_auc_roc"), value / 4))
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("model_type"),
        F.when(F.col("value") > 60, "Production").otherwise("Staging").alias("stage"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_type") == "view", known).otherwise(more).alias("metrics"),
    )


MODEL_TYPES = ["click", "error", "purchase", "signup", "view"]
