"""Whitening of embeddings with MLlib's block matrices.

A component c of a vector becomes the whole number floor(64 c) + 1,000,000; sums over the distinct vectors
(the fit list) are exact, and rows are centred as (n x - S) / n, exact before the division, so no large mean
is multiplied. Centred rows are packed into numbered blocks of a BlockMatrix.

Scatter: transposed times plain. MLlib gives all blocks that add to one block of a product to one task, so
the blocks of the fit list are laid out on a grid: block i stands in block column i % G of the left
matrix and i // G % G of the right one. The product's G x G blocks are then scatters of different rows, each
with its own task; their sum is the scatter. Its eigenvectors are found on the driver, which holds one
matrix of dimension x dimension.

Projection: the blocks times the whitening matrix (eigenvectors over the roots of the eigenvalues). The
covariance of the projected fit list, centred again, is compared with the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.tables import discard, map_arrow, ship, written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 1024
#: Distinct scatters that are added up, as the side of the grid.
GRID = 8
#: Eigenvalues below this share of the largest are zero to double precision.
LEAST_SHARE = 1e-13
BLOCK = "part long, at long, vec_ids array<long>, deviations array<decimal(38,0)>, rows int, body binary"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): vectors without NULL or a value that is not finite, in whole numbers."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(values, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return vectors.where(finite & (F.size("embedding") > 0)).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def squares(d: np.ndarray) -> list[Decimal]:
    """Exact sum of squares of every row of whole numbers."""
    most = int(np.abs(d).max()) if d.size else 0
    if most * most * d.shape[1] < 1 << 63:
        return [Decimal(int(v)) for v in (d * d).sum(axis=1)]
    return [Decimal(sum(int(v) ** 2 for v in row)) for row in d]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64 bits where they are enough, Python integers otherwise."""
    largest = max(n * int(np.abs(x).max()) if x.size else 0, max(map(abs, sums), default=0))
    whole = np.array(sums, dtype=object if largest >= 1 << 61 else np.int64)
    return x.astype(whole.dtype) * n - whole


def packed(n: int, sums: list[int], height: int):
    """Blocks of centred rows (vec_id, x), numbered within the task; ``body`` has the doubles by columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first in range(0, len(batch), height):
                block = batch.slice(first, height)
                x = block.column("x").flatten().to_numpy().reshape(len(block), len(sums))
                apart = deviations(x, n, sums)
                body = np.zeros((height, len(sums)))
                body[: len(block)] = (apart / n).astype(float)
                columns = [
                    pa.array([part]), pa.array([at]), pa.array([block.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([squares(apart)], pa.list_(pa.decimal128(38, 0))), pa.array([len(block)], pa.int32()), pa.array([body.tobytes("F")]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "at", "vec_ids", "deviations", "rows", "body"])
                at += 1

    return run


def blocks_of(rows: DataFrame, n: int, sums: list[int], height: int) -> tuple[DataFrame, int]:
    """A written table of blocks with their number ``block``, and how many numbers there are."""
    table = written(map_arrow(rows, packed(n, sums, height), BLOCK))
    # One row for each task that wrote blocks.
    counts = sorted(map(tuple, table.groupBy("part").agg(F.count("*")).collect()))
    starts = np.cumsum([0] + [c for _, c in counts])
    offsets = table.sparkSession.createDataFrame([(p, int(s)) for (p, _), s in zip(counts, starts, strict=False)], "part long, first long")
    numbered = table.join(F.broadcast(offsets), "part").withColumn("block", (F.col("first") + F.col("at")).cast("int")).drop("first", "part", "at")
    numbered.written_to = table.written_to
    return numbered, int(starts[-1])


def dense(body: bytes, columns: int) -> DenseMatrix:
    values = np.frombuffer(body, dtype=float)
    return DenseMatrix(len(values) // columns, columns, values)


def matrix(table: DataFrame, columns: int, blocks: int, height: int, grid: int = 1, by: int = 0) -> BlockMatrix:
    """The blocks as a BlockMatrix; ``grid`` and ``by`` lay them out in block columns."""
    placed = table.select("block", "body").rdd.map(lambda r: ((r[0], (r[0] // grid if by else r[0]) % grid), dense(r[1], columns)))
    return BlockMatrix(placed, height, columns, blocks * height, grid * columns)


def transposed(table: DataFrame, columns: int, blocks: int, height: int, grid: int) -> BlockMatrix:
    """The left matrix of ``scatter``: its blocks lie as in ``matrix``, mirrored."""
    placed = table.select("block", "body").rdd.map(
        lambda r: ((r[0] % grid, r[0]), DenseMatrix(columns, height, np.frombuffer(r[1], dtype=float).reshape(columns, height).ravel("F")))
    )
    return BlockMatrix(placed, columns, height, grid * columns, blocks * height)


def scatter(table: DataFrame, columns: int, blocks: int, height: int) -> np.ndarray:
    """Sum over all rows of the products of their components."""
    grid = min(GRID, blocks)
    product = transposed(table, columns, blocks, height, grid).multiply(matrix(table, columns, blocks, height, grid, by=1))
    # grid x grid matrices of dimension x dimension are added up.
    return product.blocks.map(lambda b: b[1].toArray()).treeReduce(np.add)


def projected(table: DataFrame, blocks: int, height: int, weights: np.ndarray) -> DataFrame:
    """(block, body) of the blocks' rows times ``weights``; bodies by columns."""
    spark, (columns, width) = table.sparkSession, weights.shape
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(columns, width, weights.ravel("F")))], 1), columns, width, columns, width)
    product = matrix(table, columns, blocks, height).multiply(right)
    return spark.createDataFrame(product.blocks.map(lambda b: (b[0][0], bytearray(b[1].toArray().tobytes("F")))), "block int, body binary")


def whitened_rows(body: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(body, dtype=float).reshape(width, -1).T[:rows]


def identity_error(done: DataFrame, n: int, width: int) -> float:
    """Largest entry of the covariance of whitened rows minus the identity."""

    def added(make):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for body, rows in zip(batch.column("body"), batch.column("rows"), strict=True):
                    total = total + make(whitened_rows(body.as_py(), rows.as_py(), width))
            values = np.ravel(total) if np.ndim(total) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])

        sums = map_arrow(done.select("body", "rows"), run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
        return sums.orderBy("at").toArrow().column("value").to_numpy()

    mean = added(lambda z: z.sum(axis=0)) / n
    covariance = added(lambda z: (z - mean).T @ (z - mean)).reshape(width, width) / n
    return float(np.abs(covariance - np.eye(width)).max())


def spread(width: int, usual: int, explained: list[float], error: float | None, n: int):
    """One row for each vector of a block and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, apart, rows, body in zip(*(batch.column(c) for c in ("vec_ids", "deviations", "rows", "body")), strict=True):
                rows = rows.as_py()
                values = np.full((rows, width), np.nan)
                if usual:
                    values[:, :usual] = whitened_rows(body.as_py(), rows, usual)
                place = np.repeat(np.arange(rows), width)
                columns = [
                    ids.values.take(pa.array(place)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * width, n)), apart.values.take(pa.array(place)),
                    pa.array(values.ravel(), from_pandas=True), pa.array(np.tile(np.array(explained, dtype=float), rows), from_pandas=True),
                    pa.array([error] * (rows * width), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, height: int = BLOCK_ROWS) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding) and component.

    Columns: vec_id, component (from 1, by falling eigenvalue), n (distinct vectors), deviation (sum over
    dimensions of (n x - S)^2, exact), whitened, explained (share of the component's eigenvalue in the trace),
    identity_error (one value for all rows). Vectors that are NULL or empty, or hold NULL or a value that is
    not finite, are left out; of several lengths the one most rows have is fitted (of equally frequent ones
    the shorter) and rows of others are left out. Rows that repeat count once in the fit and are all returned.
    Components whose eigenvalue is zero to double precision have NULL as whitened; if all are, explained and
    identity_error are NULL too. A number of dimensions below ``components`` gives as many components. Other
    columns are ignored. ``height`` is the number of rows in a block.
    """
    spark = vectors.sparkSession
    ship(spark)
    stored = written(usable(vectors))
    lengths = stored.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if lengths is None:
        return spark.createDataFrame([], OUT)
    size = lengths["size"]
    rows = stored.where(F.size("x") == size)
    fit = written(rows.select("x").distinct().select(F.lit(None).cast("long").alias("vec_id"), "x"))
    totals = fit.agg(F.count("*"), *(F.sum(F.col("x")[k]) for k in range(size))).first()
    n, sums = totals[0], list(totals[1:])
    fit_blocks, n_fit = blocks_of(fit, n, sums, height)
    covariance = scatter(fit_blocks, size, n_fit, height) / n
    values, vectors_ = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1], vectors_[:, ::-1]
    width, trace = min(components, size), float(np.trace(covariance))
    usual = int((values[:width] > max(values[0], 0) * LEAST_SHARE).sum()) if trace > 0 else 0
    explained = [float(v) / trace if trace > 0 else float("nan") for v in values[:width]]
    weights = axes[:, :usual] / np.sqrt(values[:usual])
    all_blocks, n_all = blocks_of(rows, n, sums, height)
    error = None
    if usual:
        fitted = written(fit_blocks.select("block", "rows").join(projected(fit_blocks, n_fit, height, weights), "block"))
        error = identity_error(fitted, n, usual)
        discard(fitted)
        bodies = all_blocks.drop("body").join(projected(all_blocks, n_all, height, weights), "block")
    else:
        bodies = all_blocks
    told = map_arrow(bodies.select("vec_ids", "deviations", "rows", "body"), spread(width, usual, explained, error, n), OUT)
    discard(stored, fit, fit_blocks)
    return told
