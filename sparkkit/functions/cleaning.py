"""Row rules for raw trip records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Inclusive bounds (low, high) of the trips used for regression.
REGRESSION_BOUNDS = {
    "trip_time_in_secs": (120, 3600),
    "fare_amount": (3, 200),
    "trip_distance": (1, 50),
    "tolls": (3, None),
}


def number(name: str) -> Column:
    """The column as a double; null when it is not a finite number."""
    value = F.col(name).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def is_number(name: str) -> Column:
    return number(name).isNotNull()


def non_zero(names: Iterable[str]) -> Column:
    """Every column is a finite number other than 0. Plain comparisons, so typed sources can use them."""
    values = [F.col(name).try_cast("double") for name in names]
    return reduce(and_, (test for v in values for test in (v != 0, F.abs(v) < float("inf"))))


def complete(df: DataFrame, names: Iterable[str]) -> Column:
    """No column is null, and no text column is empty."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    filled = (F.col(n).isNotNull() & (F.col(n) != "") if n in texts else F.col(n).isNotNull() for n in names)
    return reduce(and_, filled)


def within(bounds: Mapping[str, tuple[float | None, float | None]]) -> Column:
    """Every column is a number inside its inclusive bounds. Plain comparisons, as in ``non_zero``."""
    tests = []
    for name, (low, high) in bounds.items():
        value = F.col(name).try_cast("double")
        tests.append(value >= float("-inf" if low is None else low))
        tests.append(value < float("inf") if high is None else value <= float(high))
    return reduce(and_, tests)
