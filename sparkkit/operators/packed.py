"""Lists of numbers as bytes, for tables that a loop reads again every round.

A list reaches Arrow element by element, bytes as one copy; the bytes of all rows of a batch lie behind each other, so
numpy sees them as one array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.session import bounded_batches, materialize

#: Parts per core of a table that is read in rounds.
PARTS = 3


def flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of all lists of a column, given as lists or as bytes, and their numbers behind each other."""
    if not pa.types.is_binary(column.type):
        return column.value_lengths().to_numpy(), column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] // np.dtype(kind).itemsize
    numbers = np.frombuffer(data, kind)[ends[0] : ends[-1]] if data is not None else np.zeros(0, kind)
    return np.diff(ends), numbers


def row_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each list, 0 for empty ones."""
    out, held = np.zeros(len(lengths)), np.flatnonzero(lengths)
    if len(held):
        out[held] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[held])
    return out


def _bytes(column: pa.Array, kind: type) -> pa.Array:
    lengths, numbers = flat(column, kind)
    ends = np.concatenate([[0], np.cumsum(lengths)]) * np.dtype(kind).itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])


def _pack(kinds: dict[str, type]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = [_bytes(batch.column(i), kinds[name]) if name in kinds else batch.column(i) for i, name in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def stored_packed(rows: DataFrame, name: str, **kinds: type) -> DataFrame:
    """``rows``, stored in parts of equal size, with the named list columns as bytes of numbers of these kinds."""
    rows = bounded_batches(rows).repartition(PARTS * rows.sparkSession.sparkContext.defaultParallelism)
    schema = ", ".join(f"`{n}` {'binary' if n in kinds else kind}" for n, kind in rows.dtypes)
    return materialize(rows.mapInArrow(_pack(kinds), schema), name)


def _added(table: pa.Table) -> pa.Table:
    total = sum(part.values.to_numpy() for part in table.column("numbers"))
    return pa.table({"part": table.column("part")[:1], "numbers": [total]})


def added(parts: DataFrame, length: int, size: int) -> np.ndarray:
    """The sum of arrays that tasks emit as ``sliced``; a part is summed up in one task."""
    dealt = parts.repartition(-(-length // size), "part").groupBy("part")
    out = np.zeros(length)
    for row in dealt.applyInArrow(_added, "part bigint, numbers array<double>").toArrow().to_batches():
        for part, numbers in zip(row.column("part").to_pylist(), row.column("numbers")):
            out[part * size : part * size + len(numbers)] = numbers.values.to_numpy()
    return out


def sliced(numbers: np.ndarray, size: int) -> pa.RecordBatch:
    """``part, numbers``: an array cut into parts of a size; parts without a number but 0 are left out."""
    parts = [k for k in range(0, len(numbers), size) if numbers[k : k + size].any()]
    lists = pa.array([numbers[k : k + size] for k in parts], pa.list_(pa.from_numpy_dtype(numbers.dtype)))
    return pa.RecordBatch.from_arrays([pa.array([k // size for k in parts], pa.int64()), lists], ["part", "numbers"])
