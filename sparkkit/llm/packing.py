"""Sum-of-squares online packing of documents into windows of equal length."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import slices, texts_of
from sparkkit.llm.tokens import encode_texts

Piece = tuple[int, int, np.ndarray, int]  # doc_id, start, ids, doc_tokens
SCHEMA = (
    "sequence_id bigint, length int, ids binary, "
    "pieces array<struct<doc_id bigint, start bigint, length bigint, offset bigint, doc_tokens bigint>>"
)


class SquarePacker:
    """Windows of ``size`` tokens filled online.

    ``levels[h]`` counts the open windows with h tokens. A piece of n tokens goes to the level
    that makes the sum of the squared counts smallest: a window that is taken from level h to
    h + n changes the sum by 2 (levels[h + n] - levels[h] + 1), a new one by 2 levels[n] + 1, one
    that becomes full by 1 - 2 levels[h]. Ties go to the fullest window.

    A document longer than a window gives full windows first; only its rest is placed.
    ``close`` empties what is still open: pieces of the emptiest windows are cut to fill the
    fullest, so at most one window stays short, and that one is cut at powers of two, which
    need no padding. More than ``most_open`` open windows are closed early to bound memory.
    """

    def __init__(self, size: int = 2048, most_open: int = 4096):
        self.size, self.most_open = size, most_open
        self.levels = np.zeros(size + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self.n_open = 0

    def add(self, doc_id: int, ids: np.ndarray) -> Iterator[list[Piece]]:
        """Takes a document; yields the windows that it fills."""
        total, whole = len(ids), len(ids) - len(ids) % self.size
        for start in range(0, whole, self.size):
            yield [(doc_id, start, ids[start : start + self.size], total)]
        if whole < total:
            full = self._place((doc_id, whole, ids[whole:].copy(), total))
            if full:
                yield full
        if self.n_open > self.most_open:
            yield from self.close()

    def _place(self, piece: Piece) -> list[Piece] | None:
        n, levels, size = len(piece[2]), self.levels, self.size
        best, change = 0, 2 * levels[n] + 1
        if n < size:
            gain = levels[n + 1 : size + 1] - levels[1 : size - n + 1] + 1
            gain = 2 * gain
            gain[-1] = 1 - 2 * levels[size - n]
            gain[levels[1 : size - n + 1] == 0] = np.iinfo(np.int64).max
            at = len(gain) - 1 - int(np.argmin(gain[::-1]))
            if gain[at] <= change:
                best = at + 1
        window = self.open[best].pop() if best else []
        window.append(piece)
        if best:
            levels[best] -= 1
            self.n_open -= 1
        if best + n == size:
            return window
        levels[best + n] += 1
        self.open[best + n].append(window)
        self.n_open += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        windows = [w for level in reversed(self.open) for w in level]  # fullest first
        self.open = [[] for _ in range(self.size + 1)]
        self.levels[:] = 0
        self.n_open = 0
        first, last = 0, len(windows) - 1
        while first < last:
            window, free = windows[first], self.size - sum(len(p[2]) for p in windows[first])
            while free and first < last:
                doc_id, start, ids, total = windows[last].pop()
                window.append((doc_id, start, ids[:free], total))
                if len(ids) > free:
                    windows[last].append((doc_id, start + free, ids[free:], total))
                free -= min(free, len(ids))
                if not windows[last]:
                    last -= 1
            if not free:
                yield window
                first += 1
        if first <= last:
            yield from self._powers(windows[first])

    def _powers(self, window: list[Piece]) -> Iterator[list[Piece]]:
        left = sum(len(p[2]) for p in window)
        waiting = window[::-1]
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            out = []
            while room:
                doc_id, start, ids, total = waiting.pop()
                out.append((doc_id, start, ids[:room], total))
                if len(ids) > room:
                    waiting.append((doc_id, start + room, ids[room:], total))
                room -= min(room, len(ids))
            yield out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 2048, most_open: int = 4096) -> DataFrame:
    """Windows of at most ``size`` ids over all documents, each followed by ``end_id``.

    One row per window: its id, its length, its ids (binary: unsigned 32-bit numbers, lowest
    byte first), and its pieces in order; a piece names its document,
    how many ids of the document come before it, its length, its place in the window and the
    document's ids in all. Each partition packs its own documents as they come, without a
    shuffle; ``sequence_id`` is the partition's number times 2^40 plus a running number, so the
    same input partitions give the same windows when a task is run again. Windows are ``size``
    long; at most a few per partition are shorter, and their lengths are powers of two.

    Null and empty texts are documents of the end id alone. Repeated rows are packed one by one.
    An empty table gives no window. Columns besides doc_id and text are left out; a null doc_id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        packer = SquarePacker(size, most_open)
        number = TaskContext.get().partitionId() << 40
        ready: list[list[Piece]] = []
        for block in slices(batches):
            ids, starts = encode_texts(block.column("text"), tokenizer)
            for doc_id, a, b in zip(block.column("doc_id").to_pylist(), starts, starts[1:]):
                for window in packer.add(doc_id, np.append(ids[a:b], np.int32(end_id))):
                    ready.append(window)
                    if len(ready) >= 1024:
                        yield _rows(ready, number)
                        number += len(ready)
                        ready = []
        ready.extend(packer.close())
        for a in range(0, len(ready), 1024):
            yield _rows(ready[a : a + 1024], number + a)

    return texts_of(docs).mapInArrow(run, SCHEMA)


def _rows(windows: list[list[Piece]], first: int) -> pa.RecordBatch:
    pieces = [p for w in windows for p in w]
    lengths = np.fromiter((len(p[2]) for p in pieces), np.int64, len(pieces))
    per_window = np.concatenate([[0], np.cumsum([len(w) for w in windows])])
    ends = np.concatenate([[0], np.cumsum(lengths)])
    window_ends = ends[per_window]
    offsets = ends[:-1] - np.repeat(window_ends[:-1], np.diff(per_window))
    fields = pa.StructArray.from_arrays(
        [
            pa.array([p[0] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()), pa.array(lengths),
            pa.array(offsets), pa.array([p[3] for p in pieces], pa.int64()),
        ],
        ["doc_id", "start", "length", "offset", "doc_tokens"],
    )
    ids = np.concatenate([p[2] for p in pieces]).astype("<u4")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + len(windows), dtype=np.int64)),
            pa.array(np.diff(window_ends).astype(np.int32)),
            pa.Array.from_buffers(pa.binary(), len(windows), [None, pa.py_buffer((window_ends * 4).astype(np.int32)), pa.py_buffer(ids)]),
            pa.ListArray.from_arrays(pa.array(per_window.astype(np.int32)), fields),
        ],
        ["sequence_id", "length", "ids", "pieces"],
    )


def piece_rows(windows: DataFrame) -> DataFrame:
    """One row per piece of packed windows, with the crc32 of its ids."""
    part = F.expr("substring(ids, cast(4 * piece.offset + 1 AS int), cast(4 * piece.length AS int))")
    return windows.select("sequence_id", "ids", F.explode("pieces").alias("piece")).select(
        "piece.doc_id", "piece.start", "piece.length", F.crc32(part).alias("ids_crc32"), "piece.doc_tokens", "sequence_id", "piece.offset"
    )
