"""Whitening of embeddings with distributed block matrices.

Vectors are put on an integer grid, so equal ones are told apart exactly. Centred rows are indexed into a block matrix; its
transpose times itself, split along the rows, gives the scatter, whose eigenvectors are found locally (dimension by
dimension, whatever the number of rows). The block matrix of all rows times the whitening matrix projects them. Row
numbers of a block matrix are 32-bit in places, so rows beyond ``BAND_ROWS`` form a matrix of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# Rows of a block and of a matrix. A product is split so that a task multiplies a few blocks.
BLOCK_ROWS = 2_048
BAND_ROWS = 1 << 30
BLOCKS_A_TASK = 16
# Grid values stay below this, far beyond which doubles are no longer exact.
_GRID_LIMIT = 1 << 50


def on_grid(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """``floor(scale * c) + shift`` of every entry c, as long; entries beyond 2^50 steps stop there. Null for unusable vectors.

    Unusable: null, empty, or with an entry that is null or not finite.
    """
    usable = (F.size(vector) > 0) & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    limit = float(_GRID_LIMIT)
    grid = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(limit)), F.lit(-limit))).cast("long") + F.lit(shift).cast("long"))
    return F.when(usable, grid)


def numbered(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` stored with ``index``, counted from 0 without gaps, in the order of its partitions."""
    at = F.monotonically_increasing_id()
    stored = written(df.withColumn("_part", F.shiftright(at, 33)).withColumn("_place", at.bitwiseAND(F.lit((1 << 33) - 1))), purpose)
    # One row per partition.
    sizes = {r["_part"]: r["n"] for r in stored.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    first, total = [], 0
    for part in sorted(sizes):
        first.append((part, total))
        total += sizes[part]
    starts = df.sparkSession.createDataFrame(first, "_part long, _first long")
    return stored.join(F.broadcast(starts), "_part").withColumn("index", F.col("_first") + F.col("_place")).drop("_part", "_place", "_first")


def _blocks(rows: DataFrame, count: int, dimension: int) -> BlockMatrix:
    """A block matrix of ``rows`` (index, values) with indexes below ``count``; rows that are not there are zero."""
    vectors = rows.select(F.col("index").cast("long").alias("index"), array_to_vector("values").alias("vector"))
    old = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    # A product asks for its factors several times; what an executor loses is computed again.
    return IndexedRowMatrix(old, count, dimension).toBlockMatrix(BLOCK_ROWS, dimension).persist(StorageLevel.MEMORY_AND_DISK)


def _release(blocks: BlockMatrix) -> None:
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)


def _bands(rows: DataFrame, count: int, band_rows: int):
    """(rows with indexes from 0 on, first index, size) of each band that has rows."""
    for start in range(0, count, band_rows):
        inside = rows.where((F.col("index") >= start) & (F.col("index") < start + band_rows)) if count > band_rows else rows
        if not inside.isEmpty():
            yield inside.withColumn("index", F.col("index") - start), start, min(band_rows, count - start)


def scatter(rows: DataFrame, count: int, dimension: int, band_rows: int = BAND_ROWS) -> np.ndarray:
    """Sum of the outer products of ``values`` of all rows; the product is split along the rows and added up by key."""
    total = np.zeros((dimension, dimension))
    for part, _, size in _bands(rows, count, band_rows):
        blocks = _blocks(part, size, dimension)
        splits = -(-size // (BLOCK_ROWS * BLOCKS_A_TASK))
        # The Python class has no argument for the split of the inner dimension; without it one task would get all blocks.
        product = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
        total += BlockMatrix(product, dimension, dimension).toLocalMatrix().toArray()
        _release(blocks)
    return total


def project(rows: DataFrame, count: int, matrix: np.ndarray, purpose: str, band_rows: int = BAND_ROWS) -> DataFrame:
    """(index, projected array<double>), stored: ``values`` of every row times ``matrix``."""
    spark = rows.sparkSession
    dimension, width = matrix.shape
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(dimension, width, matrix.ravel(order="F").tolist()))], 1), dimension, width)
    parts = []
    for part, start, size in _bands(rows, count, band_rows):
        blocks = _blocks(part, size, dimension)
        made = blocks.multiply(right).toIndexedRowMatrix()
        back = callMLlibFunc("getIndexedRows", made._java_matrix_wrapper._java_model)
        parts.append(written(back.select((F.col("index") + start).alias("index"), vector_to_array("vector").alias("projected")), purpose))
        _release(blocks)
    return reduce(DataFrame.unionAll, parts)


@dataclass
class Whitening:
    """The fit: number of distinct vectors, their sums, eigenvalues and unit eigenvectors (columns) by falling eigenvalue."""

    count: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    def matrix(self, components: int) -> np.ndarray:
        """Columns that project centred rows to unit variance; a component without variance gives zeros."""
        kept = min(components, len(self.values))
        usable = self.values[:kept] > 1e-12 * max(self.values[0], 1e-300)
        return self.vectors[:, :kept] * np.where(usable, 1 / np.sqrt(np.where(usable, self.values[:kept], 1)), 0.0)


def _listed(values: list, kind: str) -> Column:
    return F.lit([str(v) for v in values]).cast(f"array<{kind}>")


def centred(x: Column, fit: Whitening) -> Column:
    """``x - S / n``, from the exact integer ``n * x - S`` where that is exact as a double."""
    n = F.lit(float(fit.count))
    return F.zip_with(x, _listed(fit.sums, "long"), lambda a, s: (a.cast("double") * n - s.cast("double")) / n)


def deviation(x: Column, fit: Whitening) -> Column:
    """Sum over the dimensions of ``(n * x - S) ** 2``, exact; null where it is no long."""
    n = F.lit(fit.count).cast("long")
    parts = F.zip_with(x, _listed(fit.sums, "long"), lambda a, s: F.try_subtract(F.try_multiply(a, n), s))
    return F.aggregate(parts, F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
    band_rows: int = BAND_ROWS,
) -> tuple[DataFrame, Whitening | None, float]:
    """Every usable row as (index, id, x, deviation, whitened array), the fit over its distinct vectors, and the identity error of that.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are those of another length than
    the commonest one (the longer of two equally common). Repeated rows and null ids are kept, each with its own result. A component
    without variance (fewer distinct vectors than components, constant entries) is 0 everywhere, and the identity error is over the
    others. Without usable rows there is no fit. Other columns are not read, so their names cannot clash.
    """
    grid = df.select(F.col(f"`{id_col}`").alias("id"), on_grid(F.col(f"`{vector_col}`"), scale, shift).alias("x")).where(F.col("x").isNotNull())
    rows = numbered(grid.withColumn("dimension", F.size("x")), "whiten-rows")
    lengths = rows.groupBy("dimension").count().orderBy(F.desc("count"), F.desc("dimension")).first()
    if lengths is None:
        return rows.select("index", "id", "x", F.lit(None).cast("long").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")), None, 0.0
    dimension = lengths["dimension"]
    # Indexes stay as they are: a row of another length is a zero row of the blocks, which adds nothing.
    kept = rows.where(F.col("dimension") == dimension).drop("dimension")
    total = rows.count()
    # The first row of each distinct vector stands for it.
    distinct = written(kept.groupBy("x").agg(F.min("index").alias("index")), "whiten-distinct")
    sums = distinct.agg(F.count("*").alias("n"), *(F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(dimension))).first()
    fit = Whitening(sums["n"], [sums[f"s{i}"] for i in range(dimension)], np.zeros(0), np.zeros((0, 0)))
    centre = distinct.select("index", centred(F.col("x"), fit).alias("values"))
    covariance = scatter(centre, total, dimension, band_rows) / fit.count
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    fit.values, fit.vectors = values[::-1], vectors[:, ::-1]
    matrix = fit.matrix(components)
    projected = project(kept.select("index", centred(F.col("x"), fit).alias("values")), total, matrix, "whiten-projected", band_rows)
    result = kept.join(projected, "index").select("index", "id", "x", deviation(F.col("x"), fit).alias("deviation"), F.col("projected").alias("whitened"))
    return result, fit, identity_error(distinct.select("index").join(projected, "index"), fit, matrix, total, band_rows)


def identity_error(projected: DataFrame, fit: Whitening, matrix: np.ndarray, total: int, band_rows: int = BAND_ROWS) -> float:
    """Largest absolute entry of the covariance of the fit's projected rows, less the identity."""
    width = matrix.shape[1]
    means = projected.agg(*(F.sum(F.col("projected")[i]).alias(f"m{i}") for i in range(width))).first()
    mean = _listed([repr(v / fit.count) for v in means], "double")
    centre = projected.select("index", F.zip_with("projected", mean, lambda a, m: a - m).alias("values"))
    covariance = scatter(centre, total, width, band_rows) / fit.count
    live = np.abs(matrix).max(axis=0) > 0
    return float(np.abs(covariance - np.eye(width))[np.ix_(live, live)].max(initial=0.0))


def whitened_components(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row per usable row and component, numbered from 1."""
    rows, fit, error = whiten(df, id_col, vector_col, components)
    if fit is None:
        explained, n = [], 0
    else:
        trace = float(fit.values.sum())
        explained, n = [repr(float(v / trace)) if trace > 0 else "0.0" for v in fit.values[:components]], fit.count
    each = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.lit(explained).cast("array<double>") if explained else F.array().cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
