"""Language-model scores by deleted interpolation.

All words and all pairs of neighbours are counted, without limit. A word's probability after another is

    l2 * C(v, w) / C(v) + l1 * C(w) / N + l0 * (C(w) + 0.5) / (N + 0.5 * (V + 1))

with weights by how often the context word itself occurs, which come from expectation-maximisation on documents
that were left out of the counts.

Texts are taken in units of some million words. A unit's distinct pairs go to buckets of keys, sorted and packed as
bytes, one row per unit and bucket; a bucket adds up the counts of all units, and answers a unit with one number for
each key, in the order in which it asked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import slices, split_words, texts_of
from sparkkit.session import materialize

#: Top bits of keys: 11 names a word, 10 a pair with a word outside the head, 0 a pair of two words of the head.
_WORD, _PAIR = np.uint64(3 << 62), np.uint64(2 << 62)
_MIX = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(xxhash.xxh3_64_intdigest(b"") >> 2) | _WORD
#: Words of a unit, and bytes of text for each bucket of keys.
UNIT, BUCKET_BYTES = 2_000_000, 4 << 20
COUNTS = "unit bigint, bucket int, keys binary, main binary, deleted binary"
UNITS = "unit bigint, doc_ids array<bigint>, sizes binary, codes binary, rare binary"


def _named(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the distinct words (the last is the end), the texts as one run of places in them, and how long each is.

    A-Z count as a-z. Each text is followed by the end.
    """
    codes, words, offsets = split_words(texts)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode().lower()) for w in words), np.uint64, len(words))
    run = np.insert(codes.astype(np.int64), offsets[1:], len(words))
    return np.append((hashes >> np.uint64(2)) | _WORD, END), run, np.diff(offsets) + 1


def _sum_equal(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of equal keys added up."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns)


def pack(numbers: np.ndarray) -> bytes:
    """The first byte of each number, then the second, …, compressed."""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as the distance of each from the one before."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


@dataclass
class Head:
    """Frequent words, by rank: names and counts. Pairs of them have keys of few bits that tell both words."""

    names: np.ndarray
    main: np.ndarray
    every: np.ndarray

    def __post_init__(self):
        self.order = np.argsort(self.names)
        self.bits = max(1, (len(self.names) - 1).bit_length())
        self.low = max(min(10, self.bits), 2 * self.bits - 32)
        self.cell = 2 * self.bits - self.low

    def ranks(self, names: np.ndarray) -> np.ndarray:
        """The rank of each word, -1 outside the head."""
        if not len(self.names):
            return np.full(len(names), -1)
        at = self.order[np.minimum(np.searchsorted(self.names, names, sorter=self.order), len(self.names) - 1)]
        return np.where(self.names[at] == names, at, -1)

    def keys(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Keys of pairs of ranks. Cells of some successive ranks of ``w`` are dealt out evenly over the numbers, and so over the buckets."""
        cells = (v.astype(np.uint64) << np.uint64(self.bits - self.low)) | (w >> self.low).astype(np.uint64)
        dealt = (cells * ((_MIX >> np.uint64(64 - self.cell)) | np.uint64(1))) & np.uint64((1 << self.cell) - 1)
        return (dealt << np.uint64(self.low)) | (w & ((1 << self.low) - 1)).astype(np.uint64)

    def buckets(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Which of ``n`` buckets holds each key; among keys with the same top bits it rises with the key."""
        spread = np.where(keys >= _PAIR, (keys >> np.uint64(30)) & np.uint64(0xFFFFFFFF), (keys >> np.uint64(self.low)) << np.uint64(32 - self.cell))
        return ((spread * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


NO_HEAD = Head(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Unit:
    """Texts as runs of codes: the rank of a word of the head, or the head's size and the place in ``rare``. Each ends with the end."""

    doc_ids: pa.Array
    sizes: np.ndarray
    codes: np.ndarray
    rare: np.ndarray  # sorted names

    def pairs(self, head: Head) -> tuple[np.ndarray, ...]:
        """Keys of the distinct pairs, sorted, how often each occurs, its two words' codes, and which of them stands at each place. Each text stands after an end."""
        kinds = len(head.names) + len(self.rare)
        before = np.concatenate([self.codes[-1:], self.codes[:-1]])
        both, places, n = np.unique(before * kinds + self.codes, return_inverse=True, return_counts=True)
        v, w = np.divmod(both, kinds)
        names = np.concatenate([head.names, self.rare])
        known = (v < len(head.names)) & (w < len(head.names))
        keys = ((names[v] * _MIX + names[w]) >> np.uint64(2)) | _PAIR
        keys[known] = head.keys(v[known], w[known])
        order = np.argsort(keys)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return keys[order], n[order], v[order], w[order], rank[places]


def _units(batches: Iterator[pa.RecordBatch], head: Head, gathered: int) -> Iterator[Unit]:
    held: list[tuple] = []
    n = 0

    def give() -> Unit:
        tables = [h[2] for h in held]
        names = np.concatenate(tables)
        starts = np.cumsum([0, *map(len, tables)])
        codes = head.ranks(names)
        rare, at = np.unique(names[codes < 0], return_inverse=True)
        codes[codes < 0] = len(head.names) + at
        doc_ids = pa.concat_arrays([h[0] for h in held])
        return Unit(doc_ids, np.concatenate([h[1] for h in held]), codes[np.concatenate([h[3] + s for h, s in zip(held, starts)])], rare)

    for block in slices(batches):
        names, run, sizes = _named(block.column("text"))
        held.append((block.column("doc_id"), sizes, names, run))
        n += len(run)
        if n >= gathered:
            yield give()
            held, n = [], 0
    if held:
        yield give()


def _stored_units(rows: DataFrame, head: Head, gathered: int, name: str) -> DataFrame:
    """The texts in units, stored: what is asked and the answers must be of the same texts."""
    shared = rows.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, unit in enumerate(_units(batches, shared.value, gathered)):
            ids = pa.ListArray.from_arrays(pa.array([0, len(unit.doc_ids)], pa.int32()), unit.doc_ids)
            packed = (pack(unit.sizes), pack(unit.codes.astype(np.uint32)), pack_keys(unit.rare))
            yield pa.RecordBatch.from_arrays([pa.array([first + k], pa.int64()), ids, *(pa.array([p], pa.binary()) for p in packed)], ["unit", "doc_ids", "sizes", "codes", "rare"])

    return materialize(rows.mapInArrow(run, UNITS), name)


def _unit(batch: pa.RecordBatch | pa.Table, row: int) -> Unit:
    sizes, codes, rare = (batch.column(c)[row].as_py() for c in ("sizes", "codes", "rare"))
    return Unit(batch.column("doc_ids")[row].values, unpack(sizes), unpack(codes, np.uint32).astype(np.int64), unpack_keys(rare))


def _dealt(unit: int | None, head: Head, buckets: int, keys: np.ndarray, *counts: np.ndarray | None) -> pa.RecordBatch:
    """Sorted keys with their main and deleted counts (or None) as a row for each bucket."""
    at = head.buckets(keys, buckets)
    order = np.argsort(at, kind="stable")
    held, first = np.unique(at[order], return_index=True)
    parts = np.split(order, first[1:])
    columns = [[pack_keys(keys[p]) for p in parts], *([None] * len(parts) if c is None else [pack(c[p]) for p in parts] for c in counts)]
    return pa.RecordBatch.from_arrays(
        [pa.array([unit] * len(parts), pa.int64()), pa.array(held, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["unit", "bucket", "keys", "main", "deleted"]
    )


def _asked(unit: Unit, head: Head) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the unit's pairs and rare words, and how often it has them."""
    keys, n, *_ = unit.pairs(head)
    return np.concatenate([keys, unit.rare]), np.concatenate([n, np.bincount(unit.codes, minlength=len(head.names) + len(unit.rare))[len(head.names) :]])


def _asked_by(units: DataFrame, head: Head, buckets: int, deleted: bool) -> DataFrame:
    """What stored units ask for; with how often they have it if they are ``deleted`` ones, to be counted as such."""
    shared = units.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                keys, n = _asked(_unit(batch, row), shared.value)
                yield _dealt(batch.column("unit")[row].as_py(), shared.value, buckets, keys, *((np.zeros_like(n), n) if deleted else (None, None)))

    return units.mapInArrow(run, COUNTS)


def _found(keys: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, counts[at], 0)


def _rows(unit: list, bucket: pa.ChunkedArray, *columns: list) -> pa.Table:
    return pa.table([pa.array(unit, pa.int64()), pa.array([bucket[0].as_py()] * len(unit), pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], ["unit", "bucket", "keys", "main", "deleted"])


def _count(table: pa.Table) -> pa.Table:
    """A bucket's keys with their counts, and each unit's answer: the main counts of what it asked for."""
    held: list[tuple[np.ndarray, ...]] = []
    n = least = 0
    for row in range(len(table)):
        held.append((unpack_keys(table["keys"][row].as_py()), *(unpack(table[c][row].as_py()) for c in ("main", "deleted"))))
        n += len(held[-1][0])
        if n > 2 * least + 1_000_000:
            held = [_sum_equal(*map(np.concatenate, zip(*held)))]
            n = least = len(held[0][0])
    keys, main, deleted = _sum_equal(*map(np.concatenate, zip(*held)))
    asking = [(u.as_py(), k.as_py()) for u, k in zip(table["unit"], table["keys"]) if u.is_valid]
    answers = [pack(_found(unpack_keys(k), keys, main)) for _, k in asking]
    none = [None] * len(asking)
    return _rows([None, *(u for u, _ in asking)], table["bucket"], [pack_keys(keys), *none], [pack(main), *answers], [pack(deleted), *none])


def _answer(table: pa.Table) -> pa.Table:
    """Each unit's answer from a bucket: all occurrences, main and deleted, of what it asked for."""
    asking, keys, every = [], np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for row, unit in enumerate(table["unit"].to_pylist()):
        if unit is not None:
            asking.append((unit, table["keys"][row].as_py()))
        else:
            keys = unpack_keys(table["keys"][row].as_py())
            every = unpack(table["main"][row].as_py()) + unpack(table["deleted"][row].as_py())
    none = [None] * len(asking)
    return _rows([u for u, _ in asking], table["bucket"], none, [pack(_found(unpack_keys(k), keys, every)) for _, k in asking], none)


def _answered(units: DataFrame, answers: DataFrame, head: Head, counts: str, buckets: int, use, schema: str) -> DataFrame:
    """``use(unit, n, cv, cw, cvw, places, words)`` of each unit: of its distinct pairs how often it has them and the counts of context, word and pair, which of
    them stands at each place, and the count of the word there. ``counts`` is the head's column that fits the answers."""
    shared = units.sparkSession.sparkContext.broadcast(head)

    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        unit, head = _unit(own, 0), shared.value
        keys, n, v, w, places = unit.pairs(head)
        asked = np.concatenate([keys, unit.rare])
        found = np.empty(len(asked), np.int64)
        given = sorted(zip(answers["bucket"].to_pylist(), range(len(answers))))
        found[np.argsort(head.buckets(asked, buckets), kind="stable")] = np.concatenate([unpack(answers["main"][row].as_py()) for _, row in given])
        table = np.concatenate([getattr(head, counts), found[len(keys) :]])
        return use(unit, n, table[v], table[w], found[: len(keys)], places, table[unit.codes])

    return units.groupBy("unit").cogroup(answers.select("unit", "bucket", "main").groupBy("unit")).applyInArrow(run, schema)


def count_words(rows: DataFrame, buckets: int, gathered: int = 1_000_000) -> DataFrame:
    """Packed counts of each word's occurrences in rows that are not and that are ``deleted``.

    A task adds up its own blocks and hands on what it has when that passes ``gathered`` words, so a
    word, however frequent, is few rows of any task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for block in slices(batches):
            names, places, sizes = _named(block.column("text"))
            out = np.repeat(block.column("deleted").to_numpy(zero_copy_only=False), sizes)
            every = np.bincount(places, minlength=len(names))
            deleted = np.bincount(places[out], minlength=len(names))
            held.append((names, every - deleted, deleted))
            n += len(names)
            if n >= gathered:
                yield _dealt(None, NO_HEAD, buckets, *_sum_equal(*map(np.concatenate, zip(*held))))
                held, n = [], 0
        if held:
            yield _dealt(None, NO_HEAD, buckets, *_sum_equal(*map(np.concatenate, zip(*held))))

    return rows.mapInArrow(run, COUNTS).groupBy("bucket").applyInArrow(_count, COUNTS)


def _listed(counts: DataFrame) -> DataFrame:
    """name, main and deleted: packed counts as a row for each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, main, deleted in zip(*(batch.column(c).to_pylist() for c in ("keys", "main", "deleted"))):
                columns = (unpack_keys(keys).view(np.int64), unpack(main), unpack(deleted))
                for a in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 100_000]) for c in columns], ["name", "main", "deleted"])

    return counts.mapInArrow(run, "name bigint, main bigint, deleted bigint")


def _frequent(words: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach: from a histogram of a few thousand bins of counts."""
    bins = F.when(F.col("n") < 1024, F.col("n")).otherwise((F.floor(F.log2(F.col("n")) * 256)).cast("bigint") - 2560 + 1024)
    rows = words.groupBy(bins.alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("bin")).collect()
    total, least = 0, None
    for row in rows:
        total += row.words
        if total > most:
            break
        least = row.least
    return least if least is not None else 2**62


#: Buckets of context counts by powers of two; 0 holds contexts that never occurred.
BUCKETS = 64


@dataclass
class WordModel:
    pairs: DataFrame  # packed counts of every pair of neighbours and of the words outside the head, a row for each bucket of keys
    buckets: int
    head: Head
    tokens: int
    distinct: int
    weights: np.ndarray  # per bucket of the context's count: l2, l1, l0


def count_pairs(rows: DataFrame, deleted: DataFrame, head: Head, buckets: int, gathered: int = UNIT) -> DataFrame:
    """Packed main and deleted counts of all pairs of neighbours and rare words of ``rows`` and of the stored units ``deleted``, with the units' answers."""
    shared = rows.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches, shared.value, gathered):
            keys, n = _asked(unit, shared.value)
            yield _dealt(None, shared.value, buckets, keys, n, np.zeros_like(n))

    asked = rows.mapInArrow(run, COUNTS).unionAll(_asked_by(deleted, head, buckets, deleted=True))
    return asked.groupBy("bucket").applyInArrow(_count, COUNTS)


def _context(counts: np.ndarray) -> np.ndarray:
    """The bucket of each context's count."""
    return np.frexp(counts + 1.0)[1] - 1


def _seen(unit: Unit, n: np.ndarray, cv: np.ndarray, cw: np.ndarray, cvw: np.ndarray, *_) -> pa.Table:
    """bucket, n, p2 and cw of a unit's pairs; equal ones are added up."""
    bucket, p2 = _context(cv), cvw / np.maximum(cv, 1)
    order = np.lexsort((cw, p2, bucket))
    bucket, p2, cw = bucket[order], p2[order], cw[order]
    first = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (p2[1:] != p2[:-1]) | (cw[1:] != cw[:-1])]))
    return pa.table({"bucket": pa.array(bucket[first], pa.int32()), "n": np.add.reduceat(n[order], first), "p2": p2[first], "cw": cw[first]})


def learn_weights(seen: DataFrame, rounds: int = 60) -> np.ndarray:
    """Weights l2, l1, l0 per bucket, by expectation-maximisation on rows (bucket, n, p2, p1, p0) of deleted pairs.

    A bucket without rows takes the weights of the next lower one that has some. Contexts that never occurred have no pair model: l2 is 0.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = [0, 0.5, 0.5]
    present: set[int] = set()
    for _ in range(rounds):
        shares = [F.element_at(F.array(*(F.lit(float(x)) for x in weights[:, k])), F.col("bucket") + 1) * F.col(f"p{2 - k}") for k in range(3)]
        total = F.greatest(shares[0] + shares[1] + shares[2], F.lit(1e-300))
        sums = seen.groupBy("bucket").agg(*(F.sum(F.col("n") * share / total).alias(f"s{k}") for k, share in enumerate(shares))).collect()
        for row in sums:
            gathered = np.array([row.s0, row.s1, row.s2]) + [0.1 * (row.bucket > 0), 0.1, 0.1]
            weights[row.bucket] = gathered / gathered.sum()
            present.add(row.bucket)
        if not sums:
            break
    for b in range(BUCKETS):
        if b > 1 and b not in present:
            weights[b] = weights[b - 1]
        weights[b, 1:] = np.maximum(weights[b, 1:], 1e-4)
        weights[b, 0] = max(weights[b, 0], 1e-4) if b else 0.0
        weights[b] /= weights[b].sum()
    return weights


def fit_words(docs: DataFrame, deleted: Column, head_words: int = 131_072, gathered: int = UNIT, bucket_bytes: int = BUCKET_BYTES) -> WordModel:
    """Learns from all rows of ``docs``; those for which ``deleted`` is true teach the weights, all of them the counts.

    Every word and every pair of neighbours is counted, in the shared folder, in a bucket for each ``bucket_bytes`` of text. The words that ``head_words``
    leaves room for are sent to all tasks (name and counts of each). Null and empty texts are an end alone; a null ``deleted`` is false; repeated rows count
    each; an empty table gives a model whose scores are still finite; other columns are left out.
    """
    rows = texts_of(docs, F.coalesce(deleted, F.lit(False)).alias("deleted"))
    buckets = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes
    numbered = _listed(materialize(count_words(rows, buckets), "words")).withColumn("n", F.col("main") + F.col("deleted"))
    totals = numbered.agg(
        F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("distinct"), F.sum("main").alias("main"), F.count_if(F.col("main") > 0).alias("kinds"),
    ).first()
    frequent = numbered.filter(F.col("n") >= _frequent(numbered, head_words)).select("name", "main", "n").toArrow()
    names, main, counts = (frequent.column(c).to_numpy() for c in ("name", "main", "n"))
    order = np.lexsort((names, -counts))
    head = Head(names.view(np.uint64)[order], main[order], counts[order])

    units = _stored_units(rows.filter("deleted"), head, gathered, "deleted-texts")
    counted = materialize(count_pairs(rows.filter("not deleted"), units, head, buckets, gathered), "pairs")
    total, kinds = totals.main or 0, totals.kinds
    met = _answered(units, counted.filter("unit is not null"), head, "main", buckets, _seen, "bucket int, n bigint, p2 double, cw bigint")
    seen = materialize(met, "deleted-pairs").select(
        "bucket", "n", "p2", (F.col("cw") / max(1, total)).alias("p1"), ((F.col("cw") + 0.5) / (total + 0.5 * (kinds + 1))).alias("p0"),
    )
    return WordModel(counted.filter("unit is null"), buckets, head, int(totals.tokens or 0), int(totals.distinct), learn_weights(seen))


def score_words(docs: DataFrame, model: WordModel, gathered: int = UNIT) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every whole text.

    Units of texts ask the buckets for the counts of their pairs and rare words, and add up by text what comes back. Null and empty texts are an end
    alone; repeated rows are scored each; an empty table stays empty; other columns are left out.
    """
    tokens, distinct, weights = model.tokens, model.distinct, model.weights

    def use(unit: Unit, n: np.ndarray, cv: np.ndarray, cw: np.ndarray, cvw: np.ndarray, places: np.ndarray, words: np.ndarray) -> pa.Table:
        l2, l1, l0 = weights[_context(cv)].T
        base = (cw + 0.5) / (tokens + 0.5 * (distinct + 1))
        chance = l2 * cvw / np.maximum(cv, 1) + l1 * cw / max(1, tokens) + l0 * base
        starts = np.cumsum(unit.sizes) - unit.sizes
        return pa.table({
            "doc_id": unit.doc_ids, "n_tokens": unit.sizes, "n_known": np.add.reduceat((words > 0).astype(np.int64), starts), "train_tokens": np.full(len(starts), tokens),
            "base_score": np.add.reduceat(np.log10(base)[places], starts), "score": np.add.reduceat(np.log10(chance)[places], starts),
        })

    units = _stored_units(texts_of(docs), model.head, gathered, "texts")
    asked = _asked_by(units, model.head, model.buckets, deleted=False).unionAll(model.pairs)
    answers = asked.groupBy("bucket").applyInArrow(_answer, COUNTS)
    schema = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return _answered(units, answers, model.head, "every", model.buckets, use, schema)
