"""Centroid clustering of integer vectors whose distances come from lookup tables.

Vectors are turned into integers once. In each round, and for each dimension, a table
holds the squared difference of every integer that occurs there to every centroid; the
distances of a vector to all centroids are then sums of one table row a dimension,
which NumPy gathers for a slice of vectors at a time. All arithmetic is exact.

Scale: the integers are written once; a round reads them, and each task returns one row
of sums for each centroid that it met, so a cluster that holds most vectors costs
nothing extra. What reaches the driver is ``k`` rows a round. Tables are made for
each slice from the values that occur in it, so they never grow with the data.

Defined cases: a vector is left out when it is null, has another width or holds a null
or non-finite entry; a row without an id is clustered like any other, but starts no
centroid while rows with ids are left; rows with the same id are vectors of their own,
those of equal hash in the order of their components; with fewer vectors than ``k``,
each starts a centroid; an empty table gives an empty result. An integer beyond
``LIMIT`` either way counts as ``LIMIT``, so that a squared distance fits a long. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.vectors import BLOCK, as_lists, blocks, finite_vectors, matrix_of, sum_blocks
from helioframe.session import stage

LIMIT = 1 << 27
SLICE = 2048  # vectors whose distances are summed at once


def integers(width: int, scale: float):
    """Arrow map to ``id``, ``x``: floor(scale * entry) of the vectors that are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _, values = finite_vectors(batch.column("vector"), width)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(scale * values), -LIMIT, LIMIT).astype(np.int32).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), as_lists(x, pa.int32())], names=["id", "x"])

    return run


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct integers of a column and the place of each entry among them."""
    low = int(column.min())
    span = int(column.max()) - low + 1
    if span > 16 * len(column) + 1024:
        return np.unique(column, return_inverse=True)
    seen = np.zeros(span, bool)
    seen[column - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[column - low]


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids, by tables of scalar differences."""
    total = np.zeros((len(x), len(centroids)), np.int64)
    row = np.empty_like(total)
    for d in range(x.shape[1]):
        values, place = occurring(x[:, d].astype(np.int64))
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += np.take(table, place, axis=0, out=row, mode="clip")
    return total


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller one of ties) and its squared distance."""
    cluster, least = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for at in range(0, len(x), SLICE):
        found = distances(x[at : at + SLICE], centroids)
        cluster[at : at + SLICE] = best = found.argmin(axis=1)
        least[at : at + SLICE] = found[np.arange(len(found)), best]
    return cluster, least


def _sums(centroids: np.ndarray):
    """Arrow map to one row a centroid and block: sums of its vectors' components, then their count."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            x = matrix_of(batch.column("x"), width).astype(np.int64)
            cluster, _ = nearest(x, centroids)
            order = np.argsort(cluster, kind="stable")
            met, first = np.unique(cluster[order], return_index=True)
            if len(met):
                sums[met, :width] += np.add.reduceat(x[order], first, axis=0)
            sums[:, width] += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(sums[:, width])
        parts = [blocks(sums[c]) for c in met]
        n = [len(p) for p in parts]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(met, n), pa.int64()),
                pa.array(np.concatenate([np.arange(i) for i in n] or [np.zeros(0)]), pa.int64()),
                as_lists(np.concatenate(parts) if parts else np.zeros((0, BLOCK), np.int64), pa.int64()),
            ],
            names=["cluster", "block", "part"],
        )

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, least = nearest(matrix_of(batch.column("x"), centroids.shape[1]).astype(np.int64), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(least)], names=["id", "cluster", "distance"]
            )

    return run


@dataclass(frozen=True)
class Clustering:
    """``assigned`` holds ``id``, ``cluster`` and ``distance``; the rest is one entry a centroid."""

    assigned: DataFrame
    centroids: np.ndarray
    inertia: list[int]

    def digest(self, cluster: int) -> str:
        """Lowercase hex sha256 of a centroid's components, as decimal integers joined by commas."""
        return hashlib.sha256(",".join(map(str, self.centroids[cluster].tolist())).encode()).hexdigest()


def cluster_vectors(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", width: int = 64, k: int = 40, rounds: int = 5,
    scale: float = 256.0, salt: str = "2",
) -> Clustering:
    """``k`` centroids after ``rounds`` rounds, and every kept vector's nearest one.

    Centroids start as the ``k`` kept vectors of least sha256 of ``salt``, a colon and
    the id. A round assigns every vector to the nearest centroid and replaces each
    centroid that has vectors by the floor of their mean.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    kept = stage(rows.mapInArrow(integers(width, scale), f"id {dict(rows.dtypes)['id']}, x array<int>"), "integers")
    named = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    start = kept.withColumn("h", named).orderBy(F.col("h").asc_nulls_last(), "x").limit(k).select("x").collect()
    centroids = np.array([r.x for r in start], np.int64).reshape(-1, width)
    for _ in range(rounds if len(centroids) else 0):
        parts = kept.mapInArrow(_sums(centroids), "cluster bigint, block bigint, part array<bigint>")
        sums = np.zeros((len(centroids), -(-(width + 1) // BLOCK), BLOCK), np.int64)
        for r in sum_blocks(parts, ["cluster", "block"]).collect():
            sums[r.cluster, r.block] = r.part
        sums = sums.reshape(len(centroids), -1)
        count = sums[:, width : width + 1]
        centroids = np.where(count > 0, sums[:, :width] // np.maximum(count, 1), centroids)
    if len(centroids):
        found = kept.mapInArrow(_assigned(centroids), f"id {dict(kept.dtypes)['id']}, cluster int, distance bigint")
        assigned = stage(found, "assigned")
    else:
        assigned = spark.createDataFrame([], f"id {dict(kept.dtypes)['id']}, cluster int, distance bigint")
    inertia = [0] * len(centroids)
    for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect():
        inertia[r.cluster] = r.s
    return Clustering(assigned, centroids, inertia)
