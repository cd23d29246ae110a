"""Embedding whitening (11): MLlib block matrices.

Entries become whole numbers on a grid, whose sums are exact. Centred rows, numbered
without a shuffle, go into a distributed BlockMatrix; its transpose times itself is the
scatter matrix, whose eigenvectors, over the roots of their eigenvalues, are the
whitening matrix. A second multiplication of block matrices projects every row.

The products of the blocks are added in several splits of the middle dimension, so
that no task holds more than a few blocks. The driver gets a matrix of the vectors'
dimension, that dimension's sums, and one key per block, of which there are at most
``MOST_BLOCKS``, as blocks grow beyond that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import only, stored
from postmill.operators.keys import numbered
from postmill.session import durable

GRID, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Components with less than this fraction of the first one's variance are noise of the arithmetic.
NO_VARIANCE = 1e-11
#: Entries are held within this on the grid, so that sums and products stay exact.
LARGEST = 1 << 40

BLOCK_BYTES, MOST_BLOCKS, BLOCKS_PER_TASK = 2_000_000, 1 << 17, 8


class Fit(NamedTuple):
    """Number of vectors, exact sums per dimension, unit eigenvectors of the covariance as
    columns, their eigenvalues, falling, and the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def clean(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``x``: vectors without null or non-finite entries, on the grid. Of several
    dimensions the most frequent one, the larger on ties, is that of the table; vectors
    of another are left out, since no covariance holds both."""
    read = only(rows, id_col, vector_col).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    bound = F.lit(float(LARGEST))
    grid = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * GRID, bound), -bound)) + SHIFT)
    kept = durable(read.where(F.col("v").isNotNull() & finite).select("id", grid.alias("x")))
    sizes = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return kept.where(F.size("x") == first["d"]) if first else kept


class _Sums(NamedTuple):
    n: int
    sums: list[int]
    low: list[int]
    high: list[int]


def _summed(kept: DataFrame) -> _Sums:
    """Exact sums and bounds per dimension; a batch hands on one row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                columns = [np.arange(x.shape[1]), np.full(x.shape[1], len(x)), x.sum(axis=0), x.min(axis=0), x.max(axis=0)]
                yield pa.record_batch([pa.array(column) for column in columns], names=["place", "n", "s", "low", "high"])

    parts = kept.select("x").mapInArrow(run, "place bigint, n bigint, s bigint, low bigint, high bigint")
    exact = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    rows = parts.groupBy("place").agg(F.sum("n").alias("n"), exact, F.min("low").alias("low"), F.max("high").alias("high"))
    rows = rows.orderBy("place").collect()
    columns = ([int(row[name]) for row in rows] for name in ("s", "low", "high"))
    return _Sums(rows[0]["n"] if rows else 0, *columns)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _deviation(x: Column, seen: _Sums) -> Column:
    """Sum over dimensions of ``(n * x - S) ** 2``, exact; null beyond 64 bits. Decimals
    only where the bounds do not rule out a larger number."""
    n, sums = seen.n, seen.sums
    most = [max(n * high - s, s - n * low) for s, low, high in zip(sums, seen.low, seen.high, strict=True)]
    if sum(bound * bound for bound in most) < 2**63 and n * max(map(abs, (*seen.low, *seen.high))) < 2**63:
        apart = F.zip_with(x, F.lit(sums), lambda entry, s: entry * n - s)
        return F.aggregate(apart, F.lit(0).cast("bigint"), lambda total, v: total + v * v)
    wide = F.array(*(F.lit(str(s)).cast("decimal(38,0)") for s in sums))
    apart = F.zip_with(x, wide, lambda entry, s: (entry.cast("decimal(19,0)") * F.lit(str(n)).cast("decimal(19,0)") - s).cast("decimal(38,0)"))
    total = F.aggregate(apart, F.lit(0).cast("decimal(38,0)"), lambda total, v: F.try_add(total, F.try_multiply(v, v).try_cast("decimal(38,0)")).try_cast("decimal(38,0)"))
    return total.try_cast("bigint")


def _blocks(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """``index`` from 0 and array ``v`` of ``width`` numbers, as blocks of whole rows."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("v").alias("vector")), "vector")
    indexed = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, width), n, width)
    high = max(BLOCK_BYTES // (8 * width), -(-n // MOST_BLOCKS), 1)
    return indexed.toBlockMatrix(high, width)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """Their product; partial products are added in so many tasks at least."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def _scatter(blocks: BlockMatrix) -> np.ndarray:
    splits = max(1, -(-blocks.numRowBlocks // BLOCKS_PER_TASK))
    scatter = _product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()
    return (scatter + scatter.T) / 2


def fitted(blocks: BlockMatrix, seen: _Sums) -> Fit:
    covariance = _scatter(blocks) / seen.n
    values, vectors = np.linalg.eigh(covariance)
    return Fit(seen.n, seen.sums, vectors[:, ::-1], values[::-1], float(np.trace(covariance)))


def _projected(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``index``, ``y``: every row of the blocks times a small matrix."""
    context, (high, wide) = blocks.blocks.ctx, matrix.shape
    local = Matrices.dense(high, wide, matrix.flatten(order="F"))
    other = BlockMatrix(context.parallelize([((0, 0), local)], 1), high, wide, high, wide)
    rows = callMLlibFunc("getIndexedRows", blocks.multiply(other).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return MLUtils.convertVectorColumnsToML(rows, "vector").select("index", vector_to_array("vector").alias("y"))


def whiten(
    rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per clean vector and component: ``id_col, component, n, deviation, whitened, explained,
    identity_error``.

    Vectors that are null or hold null or non-finite entries are left out, as are those
    of another dimension than most (see ``clean``). Components without variance cannot
    be scaled to one and are left out: a table of one vector, or of equal ones, has none
    and gives an empty result, as an empty table does. ``deviation`` is null where it
    passes 64 bits. Rows with a null or repeated id are projected each; repeated
    vectors weigh as often as they come. Further columns are not looked at.
    """
    kind = only(rows, id_col).schema[id_col].dataType
    kept = clean(rows, id_col, vector_col)
    seen = _summed(kept)
    width = len(seen.sums)
    nothing = f"`{id_col}` {kind.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not width or all(low == high for low, high in zip(seen.low, seen.high, strict=True)):
        return rows.sparkSession.createDataFrame([], nothing)
    means = [total / seen.n for total in seen.sums]
    placed = numbered(kept, "_n").select((F.col("_n") - 1).alias("index"), "id", "x")
    centred = placed.select("index", F.zip_with("x", F.lit(means), lambda x, mean: x.cast("double") - mean).alias("v"))
    blocks = _blocks(centred, seen.n, width)
    fit = fitted(blocks, seen)
    taken = [at for at in range(min(components, width)) if fit.values[at] > NO_VARIANCE * fit.values[0]]
    scaled = fit.vectors[:, taken] / np.sqrt(fit.values[taken])
    ids = placed.select("index", "id", _deviation(F.col("x"), seen).alias("deviation"))
    projected = stored(ids.join(_projected(blocks, scaled), "index"), "whitened")
    pairs = [(i, j) for i in range(len(taken)) for j in range(i + 1)]
    found = projected.agg(*(F.covar_pop(F.col("y")[i], F.col("y")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    error = max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs, strict=True))
    shares = F.lit([float(fit.values[at] / fit.trace) for at in taken])
    each = projected.select("id", "deviation", F.posexplode("y").alias("place", "whitened"))
    return each.select(
        F.col("id").alias(id_col),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(seen.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
