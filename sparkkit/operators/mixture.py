"""Gibbs sampling of a multinomial mixture over sparse document counts.

Documents stay on the executors. One job per round samples every document's cluster, adds
up the word counts per cluster and draws the next weights, block by block of cells. The driver
relays the K class weights and K × V word weights to the tasks; their number is checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkkit.operators.grouping import count_by
from sparkkit.operators.packed import flat, stored_packed
from sparkkit.operators.ranking import share_in_group, top_k_per_group

SMALLEST = np.finfo(float).tiny
#: Proposals of a gamma draw; all are rejected with a chance under 1e-20.
ATTEMPTS = 16
#: Weights (K × V) that may be sent to all tasks.
LARGEST_MODEL = 1 << 26
#: Weights that one task draws at once.
BLOCK = 1 << 15
#: Dictionary positions whose weights are looked up at once.
LOOKUPS = 1 << 11


@dataclass
class MixtureState:
    """Class weights (K), word weights (K × V), and the round and seed they belong to."""

    pi: np.ndarray
    mu: np.ndarray
    seed: int
    round: int = 0

    def check(self) -> None:
        """Both must be proper probability vectors."""
        if self.pi.shape[0] != self.mu.shape[0]:
            raise ValueError("numbers of classes differ")
        if not (abs(self.pi.sum() - 1) <= 1e-3 and np.all(np.abs(self.mu.sum(axis=1) - 1) <= 1e-3)):
            raise ValueError("weights do not sum to 1")

    def logs(self) -> tuple[np.ndarray, np.ndarray]:
        return np.log(np.maximum(self.pi, SMALLEST)), np.log(np.maximum(self.mu, SMALLEST))


def log_gammas(shape: np.ndarray, cluster: np.ndarray, pos: np.ndarray, seed: int, number: int) -> np.ndarray:
    """Logarithms of gamma draws that depend on seed, round, cluster and position only.

    Each proposal has one digest: two numbers make a normal one, the third accepts or rejects. Proposals are for the shape plus one,
    where few are rejected; a power of the fourth number brings the shape back, so small shapes work too.
    """
    d = shape + 2 / 3
    found, left = np.log(d), np.arange(len(shape))
    for attempt in range(ATTEMPTS):
        cells = zip(cluster[left].tolist(), pos[left].tolist())
        digests = b"".join(md5(f"{seed}:{number}:{c}:{p}:{attempt}".encode()).digest() for c, p in cells)
        u = (np.frombuffer(digests, ">u4").reshape(-1, 4) + 0.5) / (1 << 32)
        x = np.sqrt(-2 * np.log(u[:, 0])) * np.cos(2 * np.pi * u[:, 1])
        cube, of = (1 + x / np.sqrt(9 * d[left])) ** 3, d[left]
        log_cube = np.log(np.maximum(cube, SMALLEST))
        accepted = (cube > 0) & (np.log(u[:, 2]) < 0.5 * x * x + of - of * cube + of * log_cube)
        drawn = np.log(of) + log_cube + np.log(u[:, 3]) / shape[left]
        found[left[accepted]] = drawn[accepted]
        left = left[~accepted]
    return found


def _block_drawer(size: int, cells: int, alpha: float, beta: float, seed: int, number: int):
    """Draws all weights of one block of cells; lists of counts (``at`` in the block, ``n``) are added up."""

    def draw(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        cell = np.arange(block * BLOCK, min((block + 1) * BLOCK, cells))
        cluster, pos = cell // (size + 1), cell % (size + 1) - 1
        counts = np.zeros(len(cell), np.int64)
        for at, n in zip(table.column("at").chunks, table.column("n").chunks):
            np.add.at(counts, at.flatten().to_numpy(), n.flatten().to_numpy())
        shape = np.where(pos < 0, alpha, beta) + counts
        return pa.table({"block": [block], "log_gamma": [log_gammas(shape, cluster, pos, seed, number)]})

    return draw


def _in_blocks(counted: DataFrame, size: int) -> DataFrame:
    """Counts ``cluster, pos, n`` as ``block, at, n``."""
    cell = F.col("cluster").cast("bigint") * (size + 1) + F.col("pos") + 1
    entry = F.struct((cell % BLOCK).cast("int").alias("at"), F.col("n").cast("bigint").alias("n"))
    lists = counted.groupBy(F.floor(cell / BLOCK).alias("block")).agg(F.collect_list(entry).alias("e"))
    return lists.select("block", "e.at", "e.n")


def draw_weights(
    spark: SparkSession, counted: DataFrame | None, clusters: int, size: int, alpha: float, beta: float, seed: int, number: int
) -> DataFrame:
    """``block, log_gamma``: the Dirichlet draws that follow counts ``cluster, pos, n``, before each is divided by its sum.

    The weights of cluster after cluster, its class weight (position -1) first, are cut into blocks of ``BLOCK``; a block is drawn in one task.
    Repeated counts of a cell are added up; without counts the draw is from the prior.
    """
    return _drawn(spark, None if counted is None else _in_blocks(counted, size), clusters, size, alpha, beta, seed, number)


def _drawn(
    spark: SparkSession, lists: DataFrame | None, clusters: int, size: int, alpha: float, beta: float, seed: int, number: int
) -> DataFrame:
    """``draw_weights`` for counts ``block, at, n``."""
    cells = clusters * (size + 1)
    if cells > LARGEST_MODEL:
        raise ValueError(f"a mixture has at most {LARGEST_MODEL} weights")
    blocks = -(-cells // BLOCK)
    parts = spark.range(blocks).select(F.col("id").alias("block"), F.expr("cast(array() as array<int>) AS at"), F.expr("cast(array() as array<bigint>) AS n"))
    if lists is not None:
        parts = parts.unionByName(lists)
    draw = _block_drawer(size, cells, alpha, beta, seed, number)
    return parts.repartition(blocks, "block").groupBy("block").applyInArrow(draw, "block bigint, log_gamma array<double>")


def _shares(logs: np.ndarray) -> np.ndarray:
    """Rows of logarithms as shares of their sum."""
    parts = np.exp(logs - logs.max(axis=-1, keepdims=True, initial=-np.inf))
    return parts / parts.sum(axis=-1, keepdims=True)


def _state_of(drawn: DataFrame, clusters: int, size: int, seed: int, number: int) -> MixtureState:
    table = drawn.toArrow().sort_by("block").combine_chunks()
    logs = pc.list_flatten(table.column("log_gamma")).to_numpy().reshape(clusters, size + 1)
    return MixtureState(_shares(logs[:, 0]), _shares(logs[:, 1:]), seed, number)


def initial_state(spark: SparkSession, clusters: int, size: int, alpha: float = 0.1, beta: float = 0.1, seed: int = 0) -> MixtureState:
    """Class and word weights drawn from their priors."""
    return _state_of(draw_weights(spark, None, clusters, size, alpha, beta, seed, 0), clusters, size, seed, 0)


def next_state(rows: DataFrame, state: MixtureState, alpha: float = 0.1, beta: float = 0.1, doc: str = "doc_id") -> MixtureState:
    """One round: a cluster per document under ``state``, then new weights given the counts. A cluster without documents draws from the prior."""
    clusters, size = state.mu.shape
    shared = rows.sparkSession.sparkContext.broadcast(state.logs())
    counted = _sampled(rows, state, doc, shared, False)
    drawn = _drawn(rows.sparkSession, counted, clusters, size, alpha, beta, state.seed, state.round + 1)
    found = _state_of(drawn, clusters, size, state.seed, state.round + 1)
    shared.destroy()
    return found


def document_rows(rows: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, idx, cnt`` of ``vocabulary.term_rows``: one row per document, also of those without a dictionary word."""
    return rows.select(doc, "idx", F.col("cnt").cast("array<int>").alias("cnt"))


def uniform(seed: int, number: int, doc: str = "doc_id") -> Column:
    """A number in [0, 1) that depends on seed, round and document, never on partitioning."""
    address = F.concat_ws(":", F.lit(str(seed)), F.lit(str(number)), F.col(doc).cast("string"))
    return F.conv(F.substr(F.md5(address), F.lit(1), F.lit(13)), 16, 10).cast("double") / float(1 << 52)


def posterior(
    counts: DataFrame, word_weights: DataFrame, class_weights: DataFrame, doc: str = "doc_id", docs: DataFrame | None = None
) -> DataFrame:
    """``doc, cluster, p`` with built-in operators, for weights held in frames.

    ``word_weights`` (``cluster, pos, log_mu``) has at most K × V rows and
    ``class_weights`` (``cluster, log_pi``) K rows. The K weights of a word stand in one array,
    and a document sums K columns, so its rows are not multiplied. The largest log weight of a
    document is subtracted before the exponential. With ``docs`` the documents without any
    dictionary word stay, with the class weights as their posterior.
    """
    classes = [(row["cluster"], row["log_pi"]) for row in class_weights.orderBy("cluster").collect()]
    of = {name: i for i, (name, _) in enumerate(classes)}
    logs = [F.max(F.when(F.col("cluster") == F.lit(name), F.col("log_mu"))).alias(f"l{i}") for name, i in of.items()]
    joined = counts.join(F.broadcast(word_weights.groupBy("pos").agg(*logs)), "pos")
    sums = joined.groupBy(doc).agg(*(F.sum(F.col("cnt") * F.col(f"l{i}")).alias(f"l{i}") for i in range(len(classes))))
    if docs is not None:
        sums = docs.select(doc).distinct().join(sums, doc, "left")
    sums = sums.select(doc, *((F.coalesce(f"l{i}", F.lit(0.0)) + F.lit(weight)).alias(f"l{i}") for i, (_, weight) in enumerate(classes)))
    most = F.greatest(*(f"l{i}" for i in range(len(classes)))) if len(classes) > 1 else F.col("l0")
    powers = sums.select(doc, *(F.exp(F.col(f"l{i}") - most).alias(f"l{i}") for i in range(len(classes))))
    total = sum((F.col(f"l{i}") for i in range(len(classes))), F.lit(0.0))
    entries = F.array(*(F.struct(F.lit(name).alias("cluster"), (F.col(f"l{i}") / total).alias("p")) for name, i in of.items()))
    return powers.select(doc, F.explode(entries).alias("e")).select(doc, "e.cluster", "e.p")


def _log_sums(log_mu: np.ndarray, lengths: np.ndarray, idx: np.ndarray, cnt: np.ndarray) -> np.ndarray:
    """Per row and cluster the sum of counts times weights; ``log_mu`` has a row per word, so one look-up serves all clusters."""
    out, ends = np.zeros((len(lengths), log_mu.shape[1])), np.cumsum(lengths)
    starts, ends = (ends - lengths).tolist(), ends.tolist()
    idx, cnt, first = idx.astype(np.int64), cnt.astype(np.float64), 0
    while first < len(starts):  # rows of some LOOKUPS entries, which stay in the processor's cache
        begin, last = starts[first], first + 1
        while last < len(starts) and ends[last] - begin <= LOOKUPS:
            last += 1
        weights = log_mu.take(idx[begin : ends[last - 1]], axis=0)
        for i in range(first, last):
            np.dot(cnt[starts[i] : ends[i]], weights[starts[i] - begin : ends[i] - begin], out=out[i])
        first = last
    return out


def _sampler(shared, assign: bool):
    """Sample a cluster per document; emit the assignments, or this task's counts of (cluster, word) cells in blocks, with
    cluster sizes at word -1."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_pi, log_mu = shared.value
        clusters, size = log_mu.shape
        by_word = np.ascontiguousarray(log_mu.T)
        totals = np.zeros(0 if assign else clusters * (size + 1), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            lengths, idx = flat(batch.column("idx"), np.int32)
            cnt = flat(batch.column("cnt"), np.int32)[1]
            log_p = log_pi + _log_sums(by_word, lengths, idx, cnt)
            p = np.exp(log_p - log_p.max(axis=1, keepdims=True))
            edges = np.cumsum(p / p.sum(axis=1, keepdims=True), axis=1)
            chosen = np.sum(batch.column("u").to_numpy()[:, None] >= edges[:, :-1], axis=1)
            if assign:
                yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(chosen.astype(np.int32))], ["doc", "cluster"])
            else:
                cells = chosen * (size + 1)
                np.add.at(totals, np.repeat(cells + 1, lengths) + idx, cnt.astype(np.int64))
                np.add.at(totals, cells, 1)
        for block in range(-(-len(totals) // BLOCK)):
            part = totals[block * BLOCK : (block + 1) * BLOCK]
            at = np.flatnonzero(part)
            if len(at):
                lists = pa.array([at.astype(np.int32)]), pa.array([part[at]])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists], ["block", "at", "n"])

    return sample


def _sampled(rows: DataFrame, state: MixtureState, doc: str, shared, assign: bool) -> DataFrame:
    with_u = rows.select(F.col(doc).alias("doc"), "idx", "cnt", uniform(state.seed, state.round + 1, doc).alias("u"))
    kind = rows.schema[doc].dataType.simpleString()
    schema = f"doc {kind}, cluster int" if assign else "block bigint, at array<int>, n array<bigint>"
    return with_u.mapInArrow(_sampler(shared, assign), schema)


def assignments(rows: DataFrame, state: MixtureState, doc: str = "doc_id") -> DataFrame:
    """``doc, cluster`` drawn for the round that follows ``state``."""
    shared = rows.sparkSession.sparkContext.broadcast(state.logs())
    return _sampled(rows, state, doc, shared, True).withColumnRenamed("doc", doc)


def sweep(rows: DataFrame, state: MixtureState, doc: str = "doc_id") -> DataFrame:
    """``cluster, pos, n`` after drawing every document's cluster: word counts per
    cluster, and at position -1 its number of documents."""
    shared = rows.sparkSession.sparkContext.broadcast(state.logs())
    width = state.mu.shape[1] + 1
    entries = _sampled(rows, state, doc, shared, False).select("block", F.inline(F.arrays_zip("at", "n")))
    cell = F.col("block") * BLOCK + F.col("at")
    counted = entries.select(F.floor(cell / width).cast("int").alias("cluster"), (cell % width - 1).cast("int").alias("pos"), "n")
    return counted.groupBy("cluster", "pos").agg(F.sum("n").alias("n"))


def gibbs(
    rows: DataFrame,
    clusters: int,
    size: int,
    rounds: int = 200,
    alpha: float = 0.1,
    beta: float = 0.1,
    seed: int = 0,
    doc: str = "doc_id",
) -> tuple[MixtureState, DataFrame]:
    """Weights after ``rounds`` rounds, and the last round's ``doc, cluster``.

    A cluster that drew no document takes its next weights from the prior.
    """
    rows = stored_packed(rows.select(doc, "idx", "cnt"), "mixture-documents", idx=np.int32, cnt=np.int32)
    held = rows.persist()
    state = initial_state(rows.sparkSession, clusters, size, alpha, beta, seed)
    before = state
    try:
        for _ in range(rounds):
            before, state = state, next_state(held, state, alpha, beta, doc)
    finally:
        held.unpersist()
    return state, assignments(rows, before, doc)


def weight_frame(state: MixtureState, words: DataFrame) -> DataFrame:
    """``cluster, word, weight``: K × V rows, the size of the model."""
    spark = words.sparkSession
    clusters, size = state.mu.shape
    table = pd.DataFrame(
        {
            "cluster": np.repeat(np.arange(clusters), size).astype("int32"),
            "pos": np.tile(np.arange(size), clusters).astype("int32"),
            "weight": state.mu.ravel(),
        }
    )
    weights = spark.createDataFrame(table, "cluster int, pos int, weight double")
    return weights.join(F.broadcast(words.select("word", "pos")), "pos").select("cluster", "word", "weight")


def top_words(state: MixtureState, words: DataFrame, k: int = 50) -> DataFrame:
    """``cluster, word, weight, rank`` of the heaviest words of every cluster."""
    return top_k_per_group(weight_frame(state, words), ["cluster"], k, "weight", ["word"])


def top_categories(clustered: DataFrame, category: str, k: int = 3) -> DataFrame:
    """``cluster, category, share, rank`` of the commonest true categories of every cluster."""
    counts = share_in_group(count_by(clustered, ["cluster", category], "num"), ["cluster"], "num")
    return top_k_per_group(counts, ["cluster"], k, "share", [category]).drop("num")
