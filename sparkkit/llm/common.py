"""Helpers shared by the operators: row ids, hash folds, and word tables of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.session import new_path

#: The white space of the contracts, as a Java and DuckDB character class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once inside a task.
BLOCK_BYTES = 2 << 20
#: Rows that Spark hands to Python at once; its own default of 10,000 long texts would take much memory in each task.
BATCH_ROWS = 1000


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id written in decimal, modulo ``folds`` (null ids count as empty text)."""
    written = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.crc32(F.coalesce(written, F.lit("")).cast("binary")) % folds


def small_batches(df: DataFrame) -> None:
    """Makes the session hand at most ``BATCH_ROWS`` rows at once to Python, unless it is set to fewer."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))


def texts_of(df: DataFrame, *more: str) -> DataFrame:
    """The columns doc_id, text (null: empty) and ``more`` of ``df``, for use in Python; other columns are left out."""
    small_batches(df)
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for tables that hold whole texts: packed tightly."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about ``size`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(lengths):
            continue
        piece = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(lengths)]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def lists_to_codes(lists: pa.ListArray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Positions in a table of distinct strings, that table, and where each list begins (one more at the end)."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), offsets - offsets[0]


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """``lists_to_codes`` of the words between white space; null and blank texts have none."""
    codes, table, offsets = lists_to_codes(pc.ascii_split_whitespace(pc.fill_null(texts, "")))
    if "" not in table:
        return codes, table, offsets
    empty = table.index("")
    kept = codes != empty
    before = np.concatenate([[0], np.cumsum(kept)])
    codes = codes[kept]
    return codes - (codes > empty), table[:empty] + table[empty + 1 :], before[offsets]


class ChunkTable:
    """Ids of distinct chunks, each encoded once, and whole texts put together from them.

    ``encode`` takes a list of new chunks and returns their id lists. The table lives as long as
    the Python worker, over all its tasks; new chunks that would take it beyond ``most`` first drop the half that
    was not met for longest, which bounds memory and never changes a result.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = 500_000):
        self.encode, self.most = encode, most
        self.place: dict[str, int] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.met, self.blocks = np.zeros(0, np.int32), 0  # the block in which each chunk was met last

    def _drop(self, n: int) -> None:
        """Forgets the ``n`` chunks that were not met for longest."""
        kept = np.sort(np.argsort(self.met, kind="stable")[n:])
        lengths = np.diff(self.starts)[kept]
        ends = np.cumsum(lengths)
        chunks = list(self.place)
        self.place = {chunks[k]: at for at, k in enumerate(kept.tolist())}
        self.flat = self.flat[np.repeat(self.starts[kept] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        self.starts, self.met = np.concatenate([[0], ends]), self.met[kept]

    def ids(self, codes: np.ndarray, chunks: list[str], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, and where each text's ids begin (one more at the end)."""
        at = np.fromiter(map(self.place.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        if len(self.place) + len(new) > self.most:
            self._drop(len(self.place) // 2 if len(self.place) // 2 + len(chunks) <= self.most else len(self.place))
            at = np.fromiter(map(self.place.get, chunks, repeat(-1)), np.int64, len(chunks))
            new = np.flatnonzero(at < 0)
        if len(new):
            unmet = list(map(chunks.__getitem__, new.tolist()))
            found = self.encode(unmet)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            at[new] = len(self.place) + np.arange(len(new))
            self.place.update(zip(unmet, at[new].tolist()))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        self.blocks += 1
        self.met[at] = self.blocks
        at = at[codes]
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[offsets]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
