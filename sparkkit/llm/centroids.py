"""Centroids of vectors of whole numbers, by tables of squared differences.

A task goes through its vectors in blocks. For each dimension, each whole number that occurs there in the
block and each centroid it tabulates the squared difference; distances are sums of looked-up table rows.
Everything is exact, so the result depends on neither the partitions nor the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import small_batches
from sparkkit.llm.vectors import vector_blocks, whole_vectors
from sparkkit.session import materialize


@dataclass
class Clustering:
    """What ``cluster`` returns: ``centroids`` (clusters x dimensions, whole numbers) and the frame ``members``:
    ``vec_id, cluster, distance`` (squared) of every vector."""

    centroids: np.ndarray
    members: DataFrame

    def inertias(self) -> dict[int, int]:
        """The summed distance of every cluster that has a vector: one row per cluster reaches the driver."""
        sums = self.members.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
        return {r.cluster: r.inertia for r in sums}


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in ascending order of it.

    Rows of one id go by their components; a null id is written as nothing. A heap of ``k`` rows per task.
    """
    written = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(written.cast("binary"), 256), "q").limit(k)
    return np.array([r.q for r in first.select("q").collect()], np.int64)


def occurring_numbers(q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every dimension of a block (vectors x dimensions) the numbers that occur and each vector's place among them."""
    return [np.unique(q[:, d], return_inverse=True) for d in range(q.shape[1])]


def nearest(occurring: list[tuple[np.ndarray, np.ndarray]], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector of a block (of equally near ones the first) and the squared distance to it."""
    total = 0
    for d, (numbers, place) in enumerate(occurring):
        table = (numbers[:, None] - centroids[None, :, d]) ** 2
        total = total + table[place]
    cluster = total.argmin(1)
    return cluster, total[np.arange(len(cluster)), cluster]


def _sums(centroids: np.ndarray):
    """Per task the number of vectors and the sum of every dimension, for each centroid that has any."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for _, q in vector_blocks(batches, size):
            occurring = occurring_numbers(q)
            cluster, _ = nearest(occurring, centroids)
            count += np.bincount(cluster, minlength=k)
            for d, (numbers, place) in enumerate(occurring):
                held = np.bincount(cluster * len(numbers) + place, minlength=k * len(numbers))
                sums[:, d] += held.reshape(k, -1) @ numbers
        used = np.flatnonzero(count)
        if len(used):
            columns = [np.repeat(used, size), np.tile(np.arange(size), len(used)), sums[used].ravel(), np.repeat(count[used], size)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "dim", "total", "n"])

    return run


def _members(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, q in vector_blocks(batches, centroids.shape[1]):
            cluster, distance = nearest(occurring_numbers(q), centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid that has vectors becomes floor(sum / count) of them; the others stay.

    A task sends one row per centroid and dimension; as many come to the driver.
    """
    rows = vectors.mapInArrow(_sums(centroids), "cluster bigint, dim bigint, total bigint, n bigint")
    new = centroids.copy()
    for r in rows.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        new[r.cluster, r.dim] = r.total // r.n
    return new


def cluster(
    df: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: str = "2", vec_id: str = "vec_id", vector: str = "embedding"
) -> Clustering:
    """``rounds`` rounds from ``k`` starting vectors, then one more assignment, over all vectors of ``size`` usable components.

    Vectors that are null, of another length, or hold a null, NaN or infinite component take no part. Repeated
    rows count each; a null ``vec_id`` stays null. With fewer than ``k`` vectors each one starts a centroid; without any
    there are no centroids and no members. Other columns of ``df`` are never read. The whole numbers are stored
    once; beyond them only centroids (``k`` x ``size``) and their sums move.
    """
    small_batches(df)
    vectors = materialize(whole_vectors(df, size, scale, vec_id, vector), "whole-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return Clustering(np.zeros((0, size), np.int64), df.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint"))
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return Clustering(centroids, materialize(vectors.mapInArrow(_members(centroids), "vec_id bigint, cluster int, distance bigint"), "cluster-members"))
