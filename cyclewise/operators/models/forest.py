"""Isolation forest (Liu, Ting and Zhou, 2008) over window summaries.

Every tree draws its own sample from all rows by hash, so rows are neither multiplied
by the number of trees nor gathered. Each tree grows in its own task from at most
``sample_size`` rows. The node table has at most
``trees * 2 * sample_size`` rows and is what scoring broadcasts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclewise.constants import SEED, TREE_SAMPLE, TREES
from cyclewise.functions.numeric import ratio
from cyclewise.session import stored

NODE_SCHEMA = (
    "tree int, node int, feature int, split double, left int, right int, path double, depth int, rows int"
)
_SCALE = 1 << 53


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _fraction(*parts: Column) -> Column:
    """Even hash of the parts in [0, 1)."""
    return F.pmod(F.xxhash64(*parts), F.lit(_SCALE)) / F.lit(float(_SCALE))


def _tree_samples(
    df: DataFrame, keys: list[str], trees: int, sample_size: int, seed: int, rows: int | None = None
) -> DataFrame:
    """Per tree ``sample_size`` rows without replacement, drawn from all rows.

    Every row offers itself to every tree with a probability of twice the sample over the
    rows. The first tree that takes a row follows from one hash, by a geometric gap; only
    rows that some tree takes test the trees behind it. So about twice the samples are
    exploded and shuffled, whatever the number of rows.
    """
    rows = df.count() if rows is None else rows
    rate = min(1.0, 2.0 * sample_size / max(1, rows))

    def hits(tree: Column) -> Column:
        return _fraction(*keys, tree, F.lit(seed)) < rate

    first = F.lit(0)
    if rate < 1.0:
        gap = F.log1p(-_fraction(*keys, F.lit(seed))) / math.log1p(-rate)
        first = F.least(F.floor(gap), F.lit(trees)).cast("int")
    offered = df.select("features", *keys, first.alias("_first")).filter(F.col("_first") < trees)
    behind = F.filter(F.sequence(F.col("_first") + 1, F.lit(trees)), lambda t: (t < trees) & hits(t))
    offered = offered.select(
        "features", *keys, F.explode(F.concat(F.array("_first"), behind)).alias("tree")
    ).withColumn("draw", _fraction(*keys, F.col("tree"), F.lit(seed + 1)))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("draw", *keys))
    return offered.withColumn("place", place).filter(F.col("place") <= sample_size)


def _grow(sample: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Grow one tree from its sample."""
    tree = int(sample["tree"].iloc[0])
    ordered = sample.sort_values("place")
    x = np.array(ordered["features"].tolist(), dtype=np.float64)
    rng = np.random.default_rng([seed, tree])
    limit = math.ceil(math.log2(max(2, len(x))))
    nodes: list[tuple] = []
    open_nodes = [(0, np.arange(len(x)), 0)]
    issued = 1
    while open_nodes:
        node, members, depth = open_nodes.pop()
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(members) <= 1 or len(varying) == 0:
            path = depth + average_path(len(members))
            nodes.append((tree, node, -1, 0.0, -1, -1, path, depth, len(members)))
            continue
        feature = int(rng.choice(varying))
        # rounding must not lift the cut to the top value, or the right side is empty
        cut = float(
            min(
                rng.uniform(low[feature], high[feature]),
                np.nextafter(high[feature], low[feature]),
            )
        )
        goes_left = x[members, feature] <= cut
        left, right = issued, issued + 1
        issued += 2
        nodes.append((tree, node, feature, cut, left, right, 0.0, depth, len(members)))
        open_nodes.append((left, members[goes_left], depth + 1))
        open_nodes.append((right, members[~goes_left], depth + 1))
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def fit_nodes(
    df: DataFrame,
    keys: list[str],
    trees: int = TREES,
    sample_size: int = TREE_SAMPLE,
    seed: int = SEED,
    rows: int | None = None,
) -> DataFrame:
    """Node table of the forest; ``df`` has ``features array<double>`` and its keys."""
    samples = _tree_samples(df, keys, trees, sample_size, seed, rows)
    return samples.select("tree", "place", "features").groupBy("tree").applyInPandas(
        lambda sample: _grow(sample, seed), NODE_SCHEMA
    )


@dataclass
class NodeArrays:
    """All trees as full binary trees of one depth, level by level.

    The children of place ``i`` of a level are ``2i`` and ``2i + 1`` of the next one, so they
    need no lookup. Below a leaf all goes left, and the last level holds its path. Cuts are
    ranks among the cuts of their feature; a value is ranked once per row, not per node.
    """

    trees: int
    cuts: list[np.ndarray]
    feature: list[np.ndarray]
    rank: list[np.ndarray]
    path: np.ndarray

    #: Rows of a block times trees stay within this many places.
    BLOCK = 400_000

    @classmethod
    def of(cls, nodes: pd.DataFrame) -> NodeArrays:
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        sizes = nodes.groupby("tree", sort=True).size().to_numpy()
        roots = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        offset = np.repeat(roots, sizes)
        own = np.arange(len(nodes))
        feature, split = nodes["feature"].to_numpy(), nodes["split"].to_numpy()
        leaf = feature < 0
        left, right = (np.where(leaf, own, nodes[c].to_numpy() + offset) for c in ("left", "right"))
        cuts = [np.unique(split[feature == k]) for k in range(max(0, int(feature.max())) + 1)]
        rank = np.full(len(nodes), np.iinfo(np.int32).max, np.int32)
        for k, values in enumerate(cuts):
            rank[feature == k] = np.searchsorted(values, split[feature == k])
        level, levels = roots, []
        while not leaf[level].all():
            levels.append(level)
            level = np.column_stack([left[level], right[level]]).ravel()
        places = [np.where(leaf, 0, feature)[at].astype(np.intp) for at in levels]
        return cls(len(roots), cuts, places, [rank[at] for at in levels], nodes["path"].to_numpy()[level])

    def mean_path(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of every row over the trees."""
        block = max(1, self.BLOCK // self.trees)
        out = np.empty(len(x))
        for lo in range(0, len(x), block):
            part = x[lo : lo + block]
            # missing values go left
            ranks = [np.where(np.isnan(v), 0, np.searchsorted(c, v)) for v, c in zip(part.T, self.cuts)]
            flat = np.column_stack(ranks).astype(np.int32).ravel()
            base = (np.arange(len(part)) * len(self.cuts))[:, None]
            at = np.broadcast_to(np.arange(self.trees), (len(part), self.trees)).copy()
            place = np.empty_like(at)
            value, cut = np.empty(at.shape, np.int32), np.empty(at.shape, np.int32)
            for feature, rank in zip(self.feature, self.rank):
                # all places are valid; "clip" only spares numpy a copy
                np.take(feature, at, out=place, mode="clip")
                place += base
                np.take(flat, place, out=value, mode="clip")
                np.take(rank, at, out=cut, mode="clip")
                at += at
                at += value > cut
            out[lo : lo + block] = self.path[at].mean(axis=1)
        return out


@dataclass
class Forest:
    """Fitted forest with the score range of its fit set."""

    nodes: pd.DataFrame
    sample_size: int
    low: float | None = None
    high: float | None = None
    #: Scored fit rows, where the forest was fitted in this session.
    fit_scores: DataFrame | None = field(default=None, repr=False, compare=False)

    model_type = "isolation_forest"

    def raw_score(
        self, spark: SparkSession, features: Column, steps: int | None = None
    ) -> Column:
        """``2 ** (-mean path / average path)``, in (0, 1).

        With ``steps`` the column holds windows of that length, summarised here. All trees
        go down together, see ``NodeArrays``.
        """
        shared = spark.sparkContext.broadcast(NodeArrays.of(self.nodes))
        norm = average_path(self.sample_size)

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            n = len(column)
            if n == 0:
                return pa.array([], pa.float64())
            if steps:
                flat = column.flatten().flatten().to_numpy(zero_copy_only=False)
                windows = flat.reshape(n, steps, -1)
                x = np.hstack([windows.mean(axis=1), windows.std(axis=1)])
            else:
                x = column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            return pa.array(np.power(2.0, -shared.value.mean_path(x) / norm))

        return score(features)

    def score(self, spark: SparkSession, features: Column, steps: int | None = None) -> Column:
        """Raw score over the range of the fit set; a new extreme may leave [0, 1]."""
        return self.in_range(self.raw_score(spark, features, steps))

    def in_range(self, raw: Column) -> Column:
        if self.low is None or self.high is None:
            raise ValueError("score range unknown: fit with fit_forest or set low and high")
        return ratio(raw - F.lit(self.low), F.lit(self.high - self.low))


def fit_and_score(
    df: DataFrame,
    keys: list[str],
    trees: int = TREES,
    sample_size: int = TREE_SAMPLE,
    seed: int = SEED,
) -> tuple[Forest, DataFrame]:
    """Fit, and score the fit rows once; their raw scores are stored for the range."""
    rows = df.count()
    nodes = fit_nodes(df, keys, trees, sample_size, seed, rows).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    forest = Forest(nodes, min(sample_size, rows))
    raw = forest.raw_score(df.sparkSession, F.col("features"))
    scored = stored(df.select(*[c for c in df.columns if c != "features"], raw.alias("raw")))
    span = scored.agg(F.min("raw").alias("low"), F.max("raw").alias("high")).first()
    forest.low, forest.high = span["low"], span["high"]
    forest.fit_scores = scored.withColumn("score", forest.in_range(F.col("raw"))).drop("raw")
    return forest, forest.fit_scores


def fit_forest(df: DataFrame, keys: list[str], **options) -> Forest:
    return fit_and_score(df, keys, **options)[0]
