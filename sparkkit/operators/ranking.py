"""Top-k, ranks and shares. Every cut has a key tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str], ascending: bool = False) -> DataFrame:
    """The ``k`` first rows by ``by`` (descending unless told otherwise), then by ``ties`` ascending.

    Plans as a bounded heap per task and one merge of at most ``k`` rows per task.
    Null values of ``by`` are never ranked.
    """
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return df.where(F.col(by).isNotNull()).orderBy(order, *ties).limit(k)


def positions(df: DataFrame, by: str, ties: Sequence[str], name: str = "pos") -> DataFrame:
    """Dense positions from 0 in rank order. Only for a frame already cut to k rows."""
    order = Window.orderBy(F.col(by).desc(), *ties)
    return df.withColumn(name, F.row_number().over(order) - 1)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], k: int, by: str, ties: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """The ``k`` first rows of every group with their rank.

    Spark cuts each task's share of a group to ``k`` rows before the shuffle, so
    a large group does not reach one task.
    """
    order = Window.partitionBy(*group).orderBy(F.col(by).desc(), *ties)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def share_in_group(df: DataFrame, group: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Value divided by the sum of its group. For aggregated frames with short groups."""
    total = F.sum(value).over(Window.partitionBy(*group))
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total.cast("double")))
