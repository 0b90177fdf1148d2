"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient as a double; null for a zero denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def percent_text(share: str | Column, digits: int = 2) -> Column:
    """A percentage for display, such as ``12.5%``."""
    return F.concat(F.round(col(share), digits).cast("string"), F.lit("%"))


def hour_of(when: str | Column) -> Column:
    """Hour of a timestamp, or of text such as ``2013-01-01 17:05:00``; null when it does not parse."""
    return F.hour(col(when).try_cast("timestamp"))


def sigmoid(z: str | Column) -> Column:
    """Logistic function, safe for large arguments of either sign."""
    e = F.exp(-F.abs(col(z)))
    return F.when(col(z) >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def log1p_exp(z: str | Column) -> Column:
    """ln(1 + e^z) without overflow."""
    return F.greatest(col(z), F.lit(0.0)) + F.log1p(F.exp(-F.abs(col(z))))


def indicator(value: str | Column) -> Column:
    """1 for a positive value, otherwise 0."""
    return F.when(col(value) > 0, 1.0).otherwise(0.0)


def array_dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def array_norm(a: str | Column) -> Column:
    return F.sqrt(array_dot(a, a))


def array_cosine(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(array_dot(a, b), array_norm(a) * array_norm(b))


def array_jaccard(a: str | Column, b: str | Column) -> Column:
    """Jaccard similarity of two arrays taken as sets."""
    common = F.size(F.array_intersect(col(a), col(b)))
    return ratio(common, F.size(F.array_union(col(a), col(b))))
