"""Vectors of whole numbers from columns of floating point lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest absolute component: sums of products of up to 128 components then fit a 64-bit whole number.
MOST = 1 << 27
#: Vectors that a task handles at once.
BLOCK = 4096


def usable(vector: str) -> Column:
    """True for vectors that are not null and hold no null, NaN or infinite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite, F.lit(False))


def whole(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of every component, computed in doubles, as ``array<int>``.

    A component beyond ``MOST`` after scaling ends the job with an error, since squared distances and
    products would no longer fit a long.
    """
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return F.transform(scaled, lambda x: F.when(F.abs(x) <= MOST, x.cast("int")).otherwise(
        F.raise_error(F.lit(f"a component is beyond {MOST} after scaling"))
    ))


def whole_vectors(df: DataFrame, size: int | None = None, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, q`` of the usable vectors, of those with exactly ``size`` components if it is given; other columns are left out."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vector")).where(usable("vector"))
    if size is not None:
        rows = rows.where(F.size("vector") == size)
    return rows.select("vec_id", whole("vector", scale).alias("q"))


def vector_blocks(batches: Iterator[pa.RecordBatch], size: int, block: int = BLOCK) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and components (vectors x ``size``, 64 bits) of up to ``block`` rows of ``vec_id, q`` at a time."""
    waiting: list[pa.RecordBatch] = []

    def out() -> tuple[pa.Array, np.ndarray]:
        rows = pa.Table.from_batches(waiting).combine_chunks()
        waiting.clear()
        return rows.column("vec_id").chunk(0), rows.column("q").chunk(0).flatten().to_numpy().reshape(-1, size).astype(np.int64)

    for batch in batches:
        for a in range(0, len(batch), block):
            piece = batch.slice(a, block)
            if waiting and sum(map(len, waiting)) + len(piece) > block:
                yield out()
            waiting.append(piece)
    if waiting:
        yield out()
