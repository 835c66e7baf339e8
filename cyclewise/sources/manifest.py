"""Batches that become visible all at once.

A batch is written to a folder of its own below ``data``; then a small file below
``commits`` names that folder. The file appears by a rename to a new name, so a batch is
either there or not: a job that dies between data and commit leaves a folder that no
reader opens. A repeated batch writes a new folder and commits a higher attempt, so the
old rows go in the same moment. Readers resolve the commits first and open the named
folders only, in one scan. ``merge_batches`` rewrites many small batches as one, which
keeps the list short on a long-running stream.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DATA = "data"
COMMITS = "commits"
#: Partition column of the batch folders.
FOLDER = "batch"
COMMIT_SCHEMA = "batch_id long, attempt long, folder string, replaces array<long>"


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def _commits(spark: SparkSession, path: str) -> list:
    files, place = _files(spark, path)
    if not files.exists(place(f"{path}/{COMMITS}")):
        return []
    return spark.read.schema(COMMIT_SCHEMA).json(f"{path}/{COMMITS}").collect()


def write_data(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> str:
    """Write the rows of a batch where no reader sees them yet; returns the folder's name."""
    folder = f"{FOLDER}={batch_id}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{DATA}/{folder}")
    return folder


def commit(
    spark: SparkSession, path: str, batch_id: int, folder: str, replaces: Sequence[int] = ()
) -> None:
    """Make a folder the content of a batch; the batches it replaces count as part of it."""
    files, place = _files(spark, path)
    attempt = 1 + max((c["attempt"] for c in _commits(spark, path) if c["batch_id"] == batch_id), default=0)
    entry = {"batch_id": batch_id, "attempt": attempt, "folder": folder, "replaces": sorted(replaces)}
    files.mkdirs(place(f"{path}/{COMMITS}"))
    hidden = place(f"{path}/{COMMITS}/.{uuid.uuid4().hex}")  # readers skip names with a leading dot
    out = files.create(hidden, True)
    out.write(bytearray(json.dumps(entry) + "\n", "utf-8"))
    out.close()
    if not files.rename(hidden, place(f"{path}/{COMMITS}/{batch_id:020d}.{attempt:06d}.json")):
        raise OSError(f"cannot commit batch {batch_id} of {path}")


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write and commit; a repeated batch replaces what it wrote before."""
    commit(df.sparkSession, path, batch_id, write_data(df, path, batch_id, partition_by))


def committed(spark: SparkSession, path: str) -> dict[int, str]:
    """Folder of every visible batch: its last attempt, unless another batch has replaced it."""
    entries = _commits(spark, path)
    last = {e["batch_id"]: e for e in sorted(entries, key=lambda e: e["attempt"])}
    gone = {b for e in last.values() for b in e["replaces"]}
    return {b: e["folder"] for b, e in last.items() if b not in gone}


def _rows(spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(FOLDER, T.StringType())])
    reader = spark.read.option("basePath", f"{path}/{DATA}").schema(whole)
    return reader.parquet(*[f"{path}/{DATA}/{f}" for f in folders]).select(*schema.names)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all visible batches; partition columns prune folders as in any Parquet table."""
    return _rows(spark, path, sorted(committed(spark, path).values()), schema)


def merge_batches(
    spark: SparkSession, path: str, schema: T.StructType, upto: int, partition_by: Sequence[str] = ()
) -> None:
    """Rewrite the visible batches up to an id as one, under the largest of their ids."""
    folders = {b: f for b, f in committed(spark, path).items() if b <= upto}
    if len(folders) < 2:
        return
    last = max(folders)
    rows = _rows(spark, path, sorted(folders.values()), schema)
    commit(spark, path, last, write_data(rows, path, last, partition_by), [b for b in folders if b != last])
