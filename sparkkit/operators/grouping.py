"""Keyed aggregates, each in one pass with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.functions.scalars import col, ratio


def count_by(df: DataFrame, keys: Sequence[str], name: str = "num") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], value: str | Column, name: str = "num") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col(value)).alias(name))


def distinct_by(df: DataFrame, keys: Sequence[str], value: str, name: str = "num") -> DataFrame:
    """Distinct values per key. Duplicates go first, on (key, value), so a hot key is spread by value."""
    return df.groupBy(*keys).agg(F.count_distinct(F.col(value)).alias(name))


def ratio_by(
    df: DataFrame, keys: Sequence[str], numerator: str | Column, denominator: str | Column, name: str = "ratio"
) -> DataFrame:
    """Sum of one value over sum of another per key, without a join."""
    return df.groupBy(*keys).agg(ratio(F.sum(col(numerator)), F.sum(col(denominator))).alias(name))


def rate_by(df: DataFrame, keys: Sequence[str], condition: Column, name: str = "rate") -> DataFrame:
    """Part of the rows per key that meet the condition; keys with none keep 0."""
    return df.groupBy(*keys).agg(ratio(F.count_if(condition), F.count(F.lit(1))).alias(name))


def share_of_rows(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Percent of all rows meeting each condition, one column per name."""
    total = F.count(F.lit(1))
    return df.agg(*(ratio(100 * F.count_if(test), total).alias(name) for name, test in conditions.items()))


def mean_by(df: DataFrame, keys: Sequence[str], value: str | Column, name: str = "mean") -> DataFrame:
    """Mean as exact sum over count."""
    return df.groupBy(*keys).agg(ratio(F.sum(col(value)), F.count(col(value))).alias(name))


def max_by_key(df: DataFrame, keys: Sequence[str], value: str, name: str = "largest") -> DataFrame:
    return df.groupBy(*keys).agg(F.max(value).alias(name))
