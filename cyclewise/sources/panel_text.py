"""Raw panel files: blank-separated numbers without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclewise.constants import CYCLE, RAW_SCHEMA, UNIT
from cyclewise.operators import panel, scan_checks
from cyclewise.operators.unit_order import Layout


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """Split on runs of blanks; a value that is no number becomes NULL."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    fields = F.split(line, r"\s+")
    return (
        spark.read.text(path)
        .filter(line != "")
        .select(fields.alias("f"))
        .select(
            *[
                F.get("f", F.lit(i)).try_cast(field.dataType).alias(field.name)
                for i, field in enumerate(RAW_SCHEMA.fields)
            ]
        )
        .select(UNIT, CYCLE, *[panel.canonical(c) for c in RAW_SCHEMA.names[2:]])
    )


def read_remaining_life(spark: SparkSession, path: str) -> DataFrame:
    """One number per line; line n that is not blank belongs to unit n.

    Lines are counted per file block and numbered inside their block, so a file of
    any size is read in parallel. Only the list of blocks is ordered in one task.
    """
    text = F.regexp_replace("value", r"^\s+|\s+$", "")
    block = ["file", "block"]
    lines = (
        spark.read.text(path)
        .select(
            text.alias("rul"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        )
        .filter("rul <> ''")
    )
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lines.groupBy(*block)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    place = F.row_number().over(Window.partitionBy(*block).orderBy("at"))
    return lines.join(starts, block).select(
        (F.col("before") + place).cast("long").alias(UNIT),
        F.col("rul").cast("long").alias("rul_last"),
    )


def ingest_train(spark: SparkSession, path: str) -> DataFrame:
    """Scan, remaining life, label and simulated event time; rows per unit are counted first."""
    rows = read_panel(spark, path)
    labeled = panel.label_anomalies(panel.compute_rul(rows, layout=Layout.measured(rows)))
    return panel.add_simulated_timestamps(labeled)


def write_checked(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Ingest a training file into Parquet; the checks' report comes from the job that writes."""
    frame = ingest_train(spark, path)
    watched, seen = scan_checks.watch(frame)
    watched.write.mode("overwrite").parquet(out)
    return scan_checks.report(spark, seen, frame)


def ingest_test(
    spark: SparkSession, path: str, rul_path: str
) -> tuple[DataFrame, DataFrame]:
    frame = panel.add_simulated_timestamps(read_panel(spark, path))
    return frame, read_remaining_life(spark, rul_path)
