"""Exact search for the k largest inner products, by MaxScore over postings of the dimensions.

A term is a dimension: its posting list holds the vectors of a shard whose component there is not zero. A query
gives each list an upper bound, the largest contribution that any of its vectors can make. With the k-th best score
found so far as threshold, the lists of the smallest bounds whose sum stays below it are non-essential: a vector that
is in no other list cannot reach the threshold. Essential lists are traversed, and vectors that can still
reach it are probed in the others, as long as they can.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkkit.llm.common import small_batches
from sparkkit.llm.vectors import whole_vectors
from sparkkit.session import materialize, new_path

#: Vectors of a shard, whose postings a task builds and searches at once.
SHARD = 4096
#: Components of queries that are sent to all tasks at once (8 bytes each).
QUERY_BLOCK = 1 << 19
_FOUND = "at int, row bigint, vec_id bigint, score bigint"


class Shard:
    """Postings of up to ``SHARD`` vectors: per dimension the vectors with a component there and the components."""

    def __init__(self, rows: np.ndarray, ids: pa.Array, starts: np.ndarray, flat: np.ndarray):
        """Vector j holds the components ``flat[starts[j]:starts[j + 1]]``; missing ones count as zero."""
        self.rows, self.n = rows, len(rows)
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        lengths = np.diff(starts)
        self.dims = int(lengths.max(initial=0))
        vector = np.repeat(np.arange(self.n), lengths)
        dim = np.arange(len(flat)) - np.repeat(starts[:-1], lengths)
        self.matrix = np.zeros((self.dims, self.n), np.int64)  # for probing
        self.matrix[dim, vector] = flat
        self.lists = [(docs := np.flatnonzero(column), column[docs]) for column in self.matrix]
        self.least = self.matrix.min(1, initial=0)
        self.most = self.matrix.max(1, initial=0)

    def search(self, own: int, query: np.ndarray, k: int, threshold: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the vectors that may be among the k best: no vector left out scores ``threshold`` or more.

        ``own`` is the query's own row, which is no candidate. Without a threshold (fewer than k scores are
        known) the heads of the lists give one, if they hold k vectors.
        """
        dims = np.flatnonzero(query[: self.dims])
        weight = query[dims]
        bound = np.maximum(weight * self.most[dims], weight * self.least[dims])  # 0 is in both, so never negative
        order = np.argsort(-bound, kind="stable")
        dims, weight, bound = dims[order], weight[order], bound[order]
        if threshold is None:
            threshold = self._start(own, dims, weight, k)
        rest = np.concatenate([np.cumsum(bound[::-1])[::-1], [0]])  # rest[i]: the most that lists i and later can add
        essential = len(dims) if threshold is None else int(np.searchsorted(-rest, -threshold, "right"))
        essential = min(essential, len(dims))  # the first i with rest[i] < threshold; all lists if even an empty sum reaches it
        score = np.zeros(self.n, np.int64)
        for d, w in zip(dims[:essential], weight[:essential]):
            docs, values = self.lists[d]
            score[docs] += w * values
        alive = np.flatnonzero(self.rows != own) if threshold is None else np.flatnonzero((score + rest[essential] >= threshold) & (self.rows != own))
        score = score[alive]
        for i in range(essential, len(dims)):
            score += weight[i] * self.matrix[dims[i], alive]
            if threshold is not None:
                kept = score + rest[i + 1] >= threshold
                if not kept.all():
                    alive, score = alive[kept], score[kept]
            if not len(alive):
                break
        return alive, score

    def _start(self, own: int, dims: np.ndarray, weight: np.ndarray, k: int) -> int | None:
        """The k-th best score of the vectors with the largest contribution in the first lists, or nothing if they are too few."""
        first = min(len(dims), 4 * k)
        heads = {int((np.argmax if w > 0 else np.argmin)(self.matrix[d])) for d, w in zip(dims[:first], weight[:first])}
        heads = np.array([h for h in sorted(heads) if self.rows[h] != own], np.int64)
        if len(heads) < k:
            return None
        scores = weight @ self.matrix[np.ix_(dims, heads)]
        return int(np.sort(scores)[-k])


def _search(shared, k: int):
    """For one block of queries the k best vectors of each, among a task's shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, starts, flat = shared.value
        best: list[list[tuple[int, bool, int, int]]] = [[] for _ in own]  # (-score, null id, id, row): smaller is better

        def take(shard: Shard) -> None:
            for q in range(len(own)):
                known = best[q]
                alive, score = shard.search(own[q], flat[starts[q] : starts[q + 1]], k, -known[-1][0] if len(known) == k else None)
                if len(alive) > k:
                    first = np.lexsort((shard.rows[alive], shard.ids[alive], shard.null[alive], -score))[:k]
                    alive, score = alive[first], score[first]
                if len(alive):
                    new = zip((-score).tolist(), shard.null[alive].tolist(), shard.ids[alive].tolist(), shard.rows[alive].tolist())
                    best[q] = sorted([*known, *new])[:k]

        for shard in _shards(batches):
            take(shard)
        found = [(q, row, None if null else vec_id, -score) for q, rows in enumerate(best) for score, null, vec_id, row in rows]
        for a in range(0, len(found), 50_000):
            columns = zip(*found[a : a + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["at", "row", "vec_id", "score"])

    return run


def _shards(batches: Iterator[pa.RecordBatch], size: int = SHARD) -> Iterator[Shard]:
    waiting: list[pa.RecordBatch] = []

    def out() -> Shard:
        rows = pa.Table.from_batches(waiting).combine_chunks()
        waiting.clear()
        lists = rows.column("q").chunk(0)
        starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        return Shard(rows.column("row").to_numpy(), rows.column("vec_id").chunk(0), starts, lists.flatten().to_numpy().astype(np.int64))

    for batch in batches:
        for a in range(0, len(batch), size):
            piece = batch.slice(a, size)
            if waiting and sum(map(len, waiting)) + len(piece) > size:
                yield out()
            waiting.append(piece)
    if waiting:
        yield out()


def _numbered(vectors: DataFrame) -> DataFrame:
    """``row, vec_id, q`` stored, so that a row's number never changes."""
    return materialize(vectors.withColumn("row", F.monotonically_increasing_id()), "whole-vectors")


def top_products(
    df: DataFrame, is_query, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", block: int = QUERY_BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row where ``is_query`` (a condition on ``vec_id``) holds, the ``k`` rows
    with the largest inner product, its own row left out; fewer rows if there are fewer. Ties go to the smaller vec_id.

    Vectors that are null or hold a null, NaN or infinite component take no part. Vectors of different lengths
    are multiplied as far as both go; empty ones score 0. Repeated rows are rows of their own: as queries, and as
    candidates, also of each other. A null vec_id is a candidate, after all others of equal score. Other columns are never read.

    Queries go through all vectors in blocks of at most about ``block`` components, so what is sent to all tasks is bounded;
    a task keeps k rows per query of the block, and only those are shuffled and merged. Every block is one job whose result
    is stored at once.
    """
    spark = df.sparkSession
    small_batches(df)
    vectors = _numbered(whole_vectors(df, None, scale, vec_id, vector))
    queries = vectors.where(is_query)
    amount = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.size("q"), F.lit(1))).alias("components")).first()
    if not amount.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks = math.ceil(amount.components / block)
    queries = materialize(queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), "query-vectors")
    path = new_path(spark, "top-products")
    for number in range(blocks):
        part = queries.where(F.col("block") == number).select("row", "vec_id", "q").toArrow()
        if not part.num_rows:
            continue
        lists = part.column("q").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        shared = spark.sparkContext.broadcast((part.column("row").to_numpy(), starts, lists.flatten().to_numpy().astype(np.int64)))
        found = vectors.mapInArrow(_search(shared, k), _FOUND)
        order = Window.partitionBy("at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"at": pa.array(range(part.num_rows), pa.int32()), "query_id": part.column("vec_id")}))
        ranked.join(F.broadcast(names), "at").select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema("query_id bigint, rank int, vec_id bigint, score bigint").parquet(path)
