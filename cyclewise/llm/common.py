"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.session import configure, shared_dir

#: Rows and bytes of one Arrow batch; texts may be long, so batches stay small.
ARROW_ROWS = "1000"
ARROW_BYTES = "16777216"

#: Characters handled at once by the vectorised helpers inside a task.
SLICE_CHARS = 1_000_000


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of the corpus operators."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back; cuts lineage for several readers."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes: Sequence[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` characters; a longer row has one of its own."""
    lo, total = 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            yield lo, i
            lo, total = i, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``folds``; null id: null."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id), F.lit(folds))
