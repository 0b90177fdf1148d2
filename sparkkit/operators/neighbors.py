"""Nearest documents to query texts, and the categories they vote for."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkkit.functions.scalars import ratio
from sparkkit.functions.tokens import explode_letters
from sparkkit.operators.grouping import count_by
from sparkkit.operators.ranking import top_k, top_k_per_group
from sparkkit.session import bounded_batches, materialize, new_path


def query_weights(query: str, words: DataFrame, idf: DataFrame) -> DataFrame:
    """``pos, weight``: TF-IDF of the query text, at most one row per dictionary word."""
    text = words.sparkSession.createDataFrame([(query,)], "text string")
    counted = count_by(explode_letters(text), ["word"], "cnt")
    found = words.select("word", "pos").join(F.broadcast(counted), "word")
    total = F.sum("cnt").over(Window.partitionBy())
    weighed = found.withColumn("tf", ratio("cnt", total)).join(idf, "pos")
    return weighed.select("pos", (F.col("tf") * F.col("idf")).alias("weight"))


def score(vectors: DataFrame, weights: DataFrame, doc: str = "doc_id", metric: str = "dot") -> DataFrame:
    """``doc, score`` for every document, 0 where it shares no word with the query."""
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy()))
    weights = weights.withColumn("length", length)
    joined = vectors.select(doc, "pos", "tfidf").join(F.broadcast(weights), "pos", "left")
    product = F.sum(F.coalesce(F.col("tfidf") * F.col("weight"), F.lit(0.0)))
    if metric == "dot":
        return joined.groupBy(doc).agg(product.alias("score"))
    if metric != "cosine":
        raise ValueError(f"unknown metric {metric!r}")
    own = F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf")))
    cosine = F.try_divide(product, own * F.max("length"))
    return joined.groupBy(doc).agg(F.coalesce(cosine, F.lit(0.0)).alias("score"))


def category_vote(
    scores: DataFrame, links: DataFrame, k: int = 10, doc: str = "doc_id", category: str = "category"
) -> DataFrame:
    """``category, num``: how often each category stands among the ``k`` best (document, category) rows."""
    nearest = top_k(scores.join(links, doc), k, "score", [doc, category])
    return top_k(count_by(nearest, [category]), k, "num", [category])


#: Queries, and words of queries, that go through the documents together.
QUERIES, QUERY_WORDS = 10_000, 2_000_000
#: Scores and products of words that a task holds at once.
_CELLS = 2_000_000


def _first_k(at: np.ndarray, score: np.ndarray, docs: pa.Array, k: int) -> np.ndarray:
    """Which rows are among the k best of their query, by score, then document."""
    order = np.lexsort((pc.rank(docs, "ascending", tiebreaker="dense").to_numpy(), -score, at))
    first = np.concatenate([[True], at[order][1:] != at[order][:-1]])
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < k]


class _Best:
    """The k best documents of every query so far; ``floor`` is the score that a document must have at least to be among them."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor, self.kept = k, np.full(queries, -np.inf), None

    def take(self, docs: pa.Array, scores: np.ndarray) -> None:
        """``scores``: documents x queries."""
        row, at = np.nonzero(scores >= self.floor)
        if not len(row):
            return
        new = at, scores[row, at], docs.take(pa.array(row))
        if self.kept is not None:
            new = np.concatenate([self.kept[0], new[0]]), np.concatenate([self.kept[1], new[1]]), pa.concat_arrays([self.kept[2], new[2]])
        first = _first_k(*new, self.k)
        self.kept = at, score, _ = new[0][first], new[1][first], new[2].take(pa.array(first))
        last = np.flatnonzero(np.concatenate([at[1:] != at[:-1], [True]]))
        full = np.bincount(at, minlength=len(self.floor))[at[last]] == self.k
        self.floor[at[last][full]] = score[last][full]


def _search(shared, k: int, metric: str):
    """For one block of queries the k best documents of each, among a task's documents."""

    def chunks(idx, row, per_word, n: int):
        """Cuts the documents of a batch so that neither their scores nor the products of their words are too many."""
        products = np.concatenate([[0], np.cumsum(np.bincount(row, weights=per_word, minlength=n))])
        step = max(1, _CELLS // len(shared.value[3]))
        a = 0
        while a < n:
            b = min(n, a + step, max(a + 1, int(np.searchsorted(products, products[a] + _CELLS, "right")) - 1))
            yield a, b
            a = b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, of, weight, norms = shared.value  # by position: which queries hold the word, and with which weight
        best = _Best(len(norms), k)
        for batch in batches:
            idx, val = batch.column("idx").flatten().to_numpy(), batch.column("val").flatten().to_numpy()
            row = np.repeat(np.arange(len(batch)), batch.column("idx").value_lengths().to_numpy())
            own = np.sqrt(np.bincount(row, weights=val * val, minlength=len(batch)))
            asked = idx < len(starts) - 1
            idx, val, row = idx[asked], val[asked], row[asked]
            per_word = starts[idx + 1] - starts[idx]
            begin = np.searchsorted(row, np.arange(len(batch) + 1))
            for a, b in chunks(idx, row, per_word, len(batch)):
                part = slice(begin[a], begin[b])
                times = per_word[part]
                entry = np.repeat(np.arange(begin[a], begin[b]), times)
                posting = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(starts[idx[part]], times)
                cell = (row[entry] - a) * len(norms) + of[posting]
                scores = np.bincount(cell, weights=val[entry] * weight[posting], minlength=(b - a) * len(norms)).reshape(b - a, -1)
                if metric == "cosine":
                    length = own[a:b, None] * norms[None, :]
                    scores = np.divide(scores, length, out=np.zeros_like(scores), where=length > 0)
                best.take(batch.column("doc").slice(a, b - a), np.round(scores, 9))
        if best.kept is not None:
            at, score, docs = best.kept
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), docs, pa.array(score)], ["at", "doc", "score"])

    return run


def nearest(
    rows: DataFrame, weights: DataFrame, k: int, doc: str = "doc_id", metric: str = "dot", queries: int = QUERIES, words: int = QUERY_WORDS
) -> DataFrame:
    """``query, doc, score`` of the ``k`` best documents of every query, by rounded score, then document.

    ``rows`` are ``vocabulary.tfidf_rows``; they are stored, so that texts are read and weighed once for any number of
    queries (``weights``: ``query, pos, weight``). A block of about ``queries`` queries and ``words`` words of them, as postings by
    word, is sent to all tasks and goes through the stored rows. A task keeps the k best documents of each query, and only
    those are shuffled: neither a frame nor a matrix of documents times queries is made. Documents without a dictionary
    word take no part; those without any word of the query score 0 and fill up short results.
    """
    if metric not in ("dot", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    spark = rows.sparkSession
    kind, asked = dict(rows.dtypes)[doc], dict(weights.dtypes)["query"]
    stored = materialize(rows.where(F.size("idx") > 0).select(F.col(doc).alias("doc"), "idx", "val"), "vectors")
    schema, path = f"query {asked}, doc {kind}, score double", new_path(spark, "nearest")
    amount = weights.agg(F.count_distinct("query").alias("queries"), F.count(F.lit(1)).alias("words")).first()
    blocks = math.ceil(max(amount.queries / queries, amount.words / words))
    numbered = materialize(weights.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(max(blocks, 1))).cast("int")), "weights")
    spark.createDataFrame([], schema).write.parquet(path)
    for number in range(blocks):
        part = numbered.where(F.col("block") == number).select("query", F.col("pos").cast("int").alias("pos"), "weight").toArrow().combine_chunks()
        if not part.num_rows:
            continue
        named = part.column("query").chunk(0).dictionary_encode()
        order = np.argsort(part.column("pos").to_numpy(), kind="stable")
        pos, of, weight = part.column("pos").to_numpy()[order], named.indices.to_numpy()[order], part.column("weight").to_numpy()[order]
        starts = np.searchsorted(pos, np.arange(int(pos[-1]) + 2))
        norms = np.sqrt(np.bincount(of, weights=weight * weight, minlength=len(named.dictionary)))
        shared = spark.sparkContext.broadcast((starts, of, weight, norms))
        found = bounded_batches(stored).mapInArrow(_search(shared, k, metric), f"at int, doc {kind}, score double")
        best = top_k_per_group(found, ["at"], k, "score", ["doc"])
        names = spark.createDataFrame(pa.table({"at": pa.array(range(len(norms)), pa.int32()), "query": named.dictionary}))
        best.join(F.broadcast(names), "at").select(F.col("query").cast(asked).alias("query"), "doc", "score").write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(schema).parquet(path).withColumnRenamed("doc", doc)


def category_votes(found: DataFrame, links: DataFrame, k: int = 10, doc: str = "doc_id", category: str = "category") -> DataFrame:
    """``query, category, num``: as ``category_vote``, for every query of ``nearest``."""
    rows = top_k_per_group(found.join(links, doc), ["query"], k, "score", [doc, category]).drop("rank")
    return top_k_per_group(count_by(rows, ["query", category]), ["query"], k, "num", [category]).drop("rank")
