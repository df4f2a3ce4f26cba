"""Clustering by centroids with a progressive search in the Walsh-Hadamard domain.

Vectors are made of whole numbers, so every distance, sum and mean is exact. The transform (rows of the
Hadamard matrix by their number of sign changes, coarse first) multiplies squared distances by the number
of components; the first coefficients of most vectors hold most of a distance. A vector's coefficient
differences to all centroids are added up in steps of growing width; after each step the centroid that is
nearest so far gets its whole distance, and those whose part is already larger are strictly worse and
drop out. What is left at the end has all coefficients, and ties are decided among whole distances: the
smaller number wins.

Each round reads the table of vectors once and sends one row per cluster and task through the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.tables import discard, map_arrow, written

CENTROIDS = 40
SEED = 2
ROUNDS = 5
SCALE = 256
SIZE = 64
BLOCK_ROWS = 4096
#: Whole numbers up to here keep all sums of the search within 64 bits; larger ones are added as Python integers.
NARROW = 1 << 21
#: From here on squared distances would not fit 64 bits.
LARGEST = 1 << 27


def sequency(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``size`` (a power of two) by their number of sign changes."""
    rows = transform(np.eye(size, dtype=np.int64), np.arange(size))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def transform(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, by sums and differences only; columns in ``order``."""
    n, size = x.shape
    width = 1
    while width < size:
        pairs = x.reshape(n, size // (2 * width), 2, width)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, size)
        width *= 2
    return x[:, order]


ORDER = sequency(SIZE)
STEPS = [0, 1, 2, 4, 8, 16, 32, 64]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of every row; ties go to the smaller number."""
    if max((int(np.abs(part).max()) for part in (x, centroids) if part.size), default=0) >= NARROW:
        x, centroids = x.astype(object), centroids.astype(object)
    rows, points = transform(x, ORDER), transform(centroids, ORDER)
    n, k = len(rows), len(points)
    row, point = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    part = np.zeros(n * k, dtype=x.dtype)
    limit, tried = np.zeros(n, dtype=x.dtype), np.full(n, -1)
    for a, b in zip(STEPS[:-1], STEPS[1:], strict=True):
        apart = rows[row, a:b] - points[point, a:b]
        part += (apart * apart).sum(axis=1)
        first = np.searchsorted(row, np.arange(n))
        if b == SIZE:
            break
        least = np.minimum.reduceat(part, first)
        best = np.full(n, k)
        at_least = part == least[row]
        np.minimum.at(best, row[at_least], point[at_least])
        new = np.flatnonzero(best != tried)
        apart = rows[new] - points[best[new]]
        whole = (apart * apart).sum(axis=1)
        limit[new] = np.where(tried[new] < 0, whole, np.minimum(whole, limit[new]))
        tried[new] = best[new]
        left = part <= limit[row]
        row, point, part = row[left], point[left], part[left]
    least = np.minimum.reduceat(part, first)
    winners = np.flatnonzero(part == least[row])
    won = winners[np.searchsorted(row[winners], np.arange(n))]
    return point[won], (part[won] // SIZE).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ROWS):
            block = batch.slice(at, BLOCK_ROWS)
            x = block.column("x").flatten().to_numpy().reshape(-1, SIZE)
            if np.abs(x).max() >= LARGEST:
                raise ValueError(f"components from {LARGEST // SCALE} on make squared distances that don't fit 64 bits")
            yield block, x


def summed(centroids: np.ndarray):
    """Size of every cluster and its vectors' sum, over the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((len(centroids), SIZE), dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        for _, x in blocks(batches):
            cluster, _ = nearest(x, centroids)
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(x[order], first, axis=0)
            sizes += np.bincount(cluster, minlength=len(centroids))
        used = np.flatnonzero(sizes)
        lists = pa.array(list(sums[used]), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(sizes[used]), lists], names=["cluster", "n", "sums"])

    return run


def assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in blocks(batches):
            cluster, distance = nearest(x, centroids)
            columns = [block.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid at the floor of its vectors' mean; those without vectors stay."""
    parts = map_arrow(vectors, summed(centroids), "cluster int, n long, sums array<long>")
    added = parts.select("cluster", "n", F.posexplode("sums").alias("at", "value")).groupBy("cluster", "at")
    # One row for each component of each centroid comes to the driver.
    rows = added.agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the vectors of ``SIZE`` numbers, none NULL or not finite, in whole numbers."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(values, lambda c: F.floor(c * SCALE).cast("long"))
    return vectors.where((F.size("embedding") == SIZE) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def cluster(vectors: DataFrame, rounds: int = ROUNDS, centroids: int = CENTROIDS) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding): its cluster after ``rounds`` rounds.

    Columns: vec_id, cluster, distance (squared, to the final centroid), cluster_inertia and inertia (its sum
    over the cluster and over all), centroid_sha256 (of the centroid's components, joined by commas). Vectors
    that are NULL, of another length, or hold NULL or a value that is not finite are left out. Centroids start
    as the vectors with the least SHA-256 of "2:" and their id; rows without id come last; of fewer vectors all
    are centroids. Rows that repeat each count. Components of 2**19 or more raise. Other columns are ignored.
    """
    stored = written(usable(vectors))
    draw = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    # Broadcast with the functions: ``centroids`` vectors.
    first = stored.orderBy(draw.asc_nulls_last(), "x").limit(centroids).select("x").toArrow().column("x").to_pylist()
    points = np.array(first, dtype=np.int64).reshape(-1, SIZE)
    for _ in range(rounds if len(points) else 0):
        points = moved(stored, points)
    told = written(map_arrow(stored, assigned(points), "vec_id long, cluster int, distance long"))
    discard(stored)
    digests = [hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest() for p in points]
    spark = vectors.sparkSession
    sums = told.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    rows = sums.collect()  # one row per centroid
    whole = sum(r["cluster_inertia"] for r in rows)
    found = [(r["cluster"], r["cluster_inertia"], whole, digests[r["cluster"]]) for r in rows]
    sums = spark.createDataFrame(found, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return told.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
