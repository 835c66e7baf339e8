"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, folder: str, name: str, where: Column | None = None
) -> DataFrame:
    """One table; zone-less timestamps become instants in the UTC session zone.

    ``where`` applies to the columns as stored, so it reaches the scan; a condition on
    a converted timestamp would not.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if where is not None:
        df = df.filter(where)
    naive = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    if not naive:
        return df
    return df.select(
        *[F.col(c).cast("timestamp").alias(c) if c in naive else F.col(c) for c in df.columns]
    )
