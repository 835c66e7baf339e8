"""Reconstruction error of a linear autoencoder: principal components of flattened windows.

The components come from a randomised range finder (Halko, Martinsson and Tropp, 2011).
The covariance is never formed: a pass over the rows multiplies it with a thin matrix of
``latent + OVERSAMPLING`` columns, as sums of ``d x columns`` that the tasks make and the
shuffle adds up by row of the matrix. ``PASSES`` such passes turn a random matrix into a
basis of the leading directions; one more gives the small matrix inside that basis, whose
eigenvectors are the components. The driver and a task hold ``d x columns`` numbers, so the
number of dimensions has no limit of its own. With no more dimensions than columns the
result is exact.

With orthonormal components the squared error is the squared length of the centred row
less that of its projection, so nothing has to be projected back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.constants import LATENT_DIM, SEED

OVERSAMPLING = 32
PASSES = 2


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def _summed(
    rows: DataFrame, dimensions: int, shape: tuple[int, int], add: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """Sum over all rows of a matrix that ``add`` gives for a block of rows.

    Every task sums its own blocks; rows of the matrix are added up across tasks.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += add(_matrix(batch.column(0), dimensions))
        numbers = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), shape[1])
        place = pa.array(np.arange(shape[0], dtype=np.int32))
        yield pa.RecordBatch.from_arrays([place, numbers.cast(pa.list_(pa.float64()))], ["i", "v"])

    parts = rows.mapInArrow(partial, "i int, v array<double>")
    summed = parts.groupBy("i").agg(
        F.array(*[F.sum(F.get("v", F.lit(j))) for j in range(shape[1])]).alias("v")
    )
    out = np.zeros(shape)
    for r in summed.toLocalIterator():
        out[r["i"]] = r["v"]
    return out


@dataclass
class LinearAutoencoder:
    """Mean and orthonormal components, ``(d,)`` and ``(d, latent)``."""

    mean: np.ndarray
    components: np.ndarray

    model_type = "reconstruction"

    def error(self, spark: SparkSession, vector: Column) -> Column:
        """Mean squared error of every row."""
        shared = spark.sparkContext.broadcast((self.mean, self.components))

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            if len(column) == 0:
                return pa.array([], pa.float64())
            mean, components = shared.value
            off = _matrix(column, len(mean)) - mean
            inside = off @ components
            left = np.einsum("ij,ij->i", off, off) - np.einsum("ij,ij->i", inside, inside)
            return pa.array(np.maximum(left, 0.0) / len(mean))

        return score(vector)


def fit_reconstruction(
    df: DataFrame,
    dimensions: int,
    vector: str = "features",
    latent: int = LATENT_DIM,
    passes: int = PASSES,
    seed: int = SEED,
) -> LinearAutoencoder:
    """Fit on normal rows; ``vector`` is an ``array<double>`` of ``dimensions`` values."""
    rows = df.select(F.col(vector).cast("array<double>").alias("v"))
    totals = _summed(  # as one column, so that the shuffle spreads long vectors
        rows, dimensions, (dimensions + 1, 1), lambda x: np.append(x.sum(axis=0), len(x))[:, None]
    )[:, 0]
    if totals[-1] == 0:
        raise ValueError("no rows to fit on")
    mean = totals[:-1] / totals[-1]
    columns = min(dimensions, latent + OVERSAMPLING)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, columns)))[0]

    def times(x: np.ndarray, q: np.ndarray) -> np.ndarray:
        off = x - mean
        return off.T @ (off @ q)

    for _ in range(passes if columns < dimensions else 0):
        q = basis
        basis = np.linalg.qr(_summed(rows, dimensions, (dimensions, columns), lambda x: times(x, q)))[0]

    def inside(x: np.ndarray) -> np.ndarray:
        projected = (x - mean) @ basis
        return projected.T @ projected

    small = _summed(rows, dimensions, (columns, columns), inside)
    leading = np.linalg.eigh(small)[1][:, ::-1][:, : min(latent, dimensions - 1)]
    return LinearAutoencoder(mean, basis @ leading)


def reconstruction_error(
    df: DataFrame, model: LinearAutoencoder, vector: str = "features", out: str = "score"
) -> DataFrame:
    """Mean squared error per row."""
    return df.withColumn(out, model.error(df.sparkSession, F.col(vector).cast("array<double>")))
