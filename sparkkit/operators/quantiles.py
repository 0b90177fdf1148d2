"""Exact quantiles and fence outliers for columns of any size.

A rank is found by narrowing a bracket of values: each pass counts the rows of
the bracket in buckets and keeps the bucket that holds the rank. The first pass has a
bucket for each sign and power of two; later ones cut what is left, whose values
differ by less than twofold, into equal widths. With the default of 4,096 buckets, 52 bits of a
fraction are used up after five of these. No task or driver sees more than bucket counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.session import materialize


@dataclass(frozen=True)
class Bracket:
    """Values from ``low`` to ``high``, with ``below`` rows under them."""

    low: float
    high: float
    below: int


def _power(value: Column) -> Column:
    """A number that grows with the value: its sign and power of two; 0 for zero, 9999 for infinity."""
    size = F.abs(value)
    power = F.when(size == float("inf"), 9999).otherwise(F.floor(F.log2(size)).cast("int") + 2000)
    return F.when(value == 0, 0).when(value < 0, -power).otherwise(power)


def _cell(value: Column, low: float, high: float, buckets: int) -> Column:
    """Number of the equal-width bucket; low and high are alike in size, and are scaled to near 1 first."""
    shift = -math.frexp(max(abs(low), abs(high)))[1]
    steps = (2.0 ** (shift // 2), 2.0 ** (shift - shift // 2))  # each a power of two in range, so exact
    from_low, to_high = low * steps[0] * steps[1], high * steps[0] * steps[1]
    scaled = value * F.lit(steps[0]) * F.lit(steps[1])
    return F.least(F.floor((scaled - from_low) / ((to_high - from_low) / buckets)).cast("int"), F.lit(buckets - 1))


def _narrow(rows: DataFrame, ranks: set[int], buckets: int) -> dict[int, float]:
    """The value at every rank."""
    value = F.col("v")
    found: dict[int, Bracket | None] = dict.fromkeys(ranks)
    wide: list[Bracket | None] = [None]
    while wide:
        which, at = F.lit(None).cast("int"), F.lit(None).cast("int")
        for number, b in enumerate(wide):
            inside = value.between(b.low, b.high) if b else F.lit(True)
            which = F.when(inside, number).otherwise(which)
            at = F.when(inside, _cell(value, b.low, b.high, buckets) if b else _power(value)).otherwise(at)
        counted = (
            rows.select(which.alias("which"), at.alias("at"), value.alias("v"))
            .where("which is not null")
            .groupBy("which", "at")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        cells: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r.which, r.at)):
            cells.setdefault(row.which, []).append(row)
        for rank, b in found.items():
            if b in wide:
                below = b.below if b else 0
                for row in cells[wide.index(b)]:
                    if rank < below + row.n:
                        found[rank] = Bracket(row.low, row.high, below)
                        break
                    below += row.n
        wide = sorted({b for b in found.values() if b.low < b.high}, key=lambda b: b.low)
    return {rank: b.low for rank, b in found.items()}


def _between(low: float, high: float, part: float) -> float:
    """Linear interpolation; an infinite neighbour wins, opposite infinities give NaN."""
    if part == 0 or low == high:
        return low
    if math.isinf(low) or math.isinf(high):
        return low + high
    if math.isinf(high - low):
        return low * (1 - part) + high * part
    return low + (high - low) * part


def _known(df: DataFrame, column: str) -> DataFrame:
    """The values of the column as ``v``, stored; nulls and NaN are left out."""
    value = F.col(column).cast("double")
    return materialize(df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")), "values")


def _spots(rows: DataFrame, probabilities: Sequence[float], buckets: int = 4096) -> tuple[list[float], float]:
    """Percentiles of ``v``, and its mean."""
    n, mean = rows.agg(F.count(F.lit(1)), F.avg("v")).first()
    if not n:
        raise ValueError("no values")
    spots = [(n - 1) * p for p in probabilities]
    at = _narrow(rows, {edge for spot in spots for edge in (math.floor(spot), math.ceil(spot))}, buckets)
    return [_between(at[math.floor(s)], at[math.ceil(s)], s - math.floor(s)) for s in spots], mean


def percentiles(df: DataFrame, column: str, probabilities: Sequence[float], buckets: int = 4096) -> list[float]:
    """Exact percentiles with linear interpolation between neighbouring ranks.

    Nulls and NaN are left out; infinities count as the least and the largest values.
    """
    return _spots(_known(df, column), probabilities, buckets)[0]


def quartiles(df: DataFrame, column: str) -> DataFrame:
    """One row: ``q1, q3``."""
    q1, q3 = percentiles(df, column, [0.25, 0.75])
    return df.sparkSession.createDataFrame([(q1, q3)], "q1 double, q3 double")


def centre(df: DataFrame, column: str) -> DataFrame:
    """One row: ``mean, median``, both without nulls and NaN."""
    (median,), mean = _spots(_known(df, column), [0.5])
    return df.sparkSession.createDataFrame([(mean, median)], "mean double, median double")


def fence_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Rows outside the quartile fences, with ``gap``, their distance from the nearer fence.

    The input is computed once and stored, as it is read for the fences and for the rows.
    """
    df = materialize(df, "fenced")
    q1, q3 = percentiles(df, column, [0.25, 0.75])
    low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
    value = F.col(column)
    gap = F.when(value < low, low - value).when(value > high, value - high)
    return df.withColumn("gap", gap).where("gap is not null")
