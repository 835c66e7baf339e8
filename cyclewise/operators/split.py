"""Train / validation / test split by unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.constants import SEED, TEST_SIZE, UNIT, VALIDATION_SIZE

_PREFIX = 3  # hex digits: 4096 even parts of the hash space


def unit_hash(seed: int, unit: str = UNIT) -> Column:
    return F.md5(F.concat_ws(":", F.col(unit).cast("string"), F.lit(str(seed))))


def split_sizes(n_units: Column, test_size: float, validation_size: float) -> tuple[Column, Column]:
    """Number of training units, and of training plus validation units."""
    test_start = F.floor(n_units * F.lit(1 - test_size)).cast("int")
    share = 1 - validation_size / (1 - test_size)
    return F.floor(test_start * F.lit(share)).cast("int"), test_start


def unit_split(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    validation_size: float = VALIDATION_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """``(unit_id, split)``: units in hash order, cut at the two exact sizes.

    Ranks come from hash prefixes, so the unit list is never ordered in one task:
    units are numbered inside a prefix and shifted by the at most 4096 prefix counts.
    """
    units = df.select(UNIT).distinct().withColumn("_hash", unit_hash(seed))
    units = units.withColumn("_part", F.substring("_hash", 1, _PREFIX))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        units.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy()).alias("_units"),
        )
    )
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy("_hash"))
    train_end, val_end = split_sizes(F.col("_units"), test_size, validation_size)
    return (
        units.join(F.broadcast(parts), "_part")
        .withColumn("_rank", rank)
        .select(
            UNIT,
            F.when(F.col("_rank") <= train_end, "train")
            .when(F.col("_rank") <= val_end, "val")
            .otherwise("test")
            .alias("split"),
        )
    )


def split_borders(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    validation_size: float = VALIDATION_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """One row with the largest hash of the training and of the validation units."""
    named = unit_split(df, test_size, validation_size, seed).withColumn("_hash", unit_hash(seed))
    return named.agg(
        F.max(F.when(F.col("split") == "train", F.col("_hash"))).alias("train"),
        F.max(F.when(F.col("split") != "test", F.col("_hash"))).alias("val"),
    )


def with_split(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    validation_size: float = VALIDATION_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Tag every row with its split by comparing hashes; the rows are not shuffled."""
    border = split_borders(df, test_size, validation_size, seed).first()
    own = unit_hash(seed)
    train = own <= F.lit(border["train"]) if border["train"] else F.lit(False)
    val = own <= F.lit(border["val"]) if border["val"] else F.lit(False)
    return df.withColumn("split", F.when(train, "train").when(val, "val").otherwise("test"))


def split_frames(df: DataFrame, **kwargs) -> dict[str, DataFrame]:
    tagged = with_split(df, **kwargs)
    return {
        name: tagged.filter(F.col("split") == name).drop("split")
        for name in ("train", "val", "test")
    }
