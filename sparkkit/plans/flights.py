"""Questions over flights (columns of ``read_flights``) and airports (``iata_code, state``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.functions.scalars import ratio
from sparkkit.operators.grouping import count_by, max_by_key, mean_by, rate_by, sum_by
from sparkkit.operators.ranking import top_k

# Fixed values.
CANCELLED = "1"
WEEKEND = (6, 7)
JANUARY = 1


def cancelled() -> Column:
    return F.col("cancelled") == CANCELLED


def origins(flights: DataFrame) -> DataFrame:
    return flights.select("origin_airport").distinct()


def routes(flights: DataFrame) -> DataFrame:
    return flights.select("origin_airport", "destination_airport").distinct()


def worst_delay(flights: DataFrame, entity: str, where: Column) -> DataFrame:
    """One row: the entity that owns the largest single delay among the chosen flights."""
    chosen = flights.where(where).select(entity, "departure_delay")
    return top_k(chosen, 1, "departure_delay", [entity])


def worst_airport_in_january(flights: DataFrame) -> DataFrame:
    return worst_delay(flights, "origin_airport", F.col("month") == JANUARY)


def worst_carrier_on_weekends(flights: DataFrame) -> DataFrame:
    return worst_delay(flights, "airline", F.col("day_of_week").isin(*WEEKEND))


def most_cancelled_airport(flights: DataFrame) -> DataFrame:
    return top_k(count_by(flights.where(cancelled()), ["origin_airport"]), 1, "num", ["origin_airport"])


def cancel_ratio(flights: DataFrame) -> DataFrame:
    return rate_by(flights, ["airline"], cancelled(), "ratio")


def max_delay(flights: DataFrame, *keys: str) -> DataFrame:
    return max_by_key(flights, keys or ("airline",), "departure_delay", "max_delay")


def mean_delay(flights: DataFrame, *keys: str, missing: str = "zero") -> DataFrame:
    """Mean delay per key; a missing delay counts as 0, or not at all with ``missing='ignore'``."""
    if missing not in ("zero", "ignore"):
        raise ValueError(f"unknown treatment {missing!r}")
    delay = F.col("departure_delay")
    if missing == "zero":
        delay = F.coalesce(delay, F.lit(0))
    return mean_by(flights, keys or ("airline",), delay, "avg_delay")


def worst_cancel_date(flights: DataFrame) -> DataFrame:
    """One row: the date with the highest part of cancelled flights."""
    date = ["year", "month", "day"]
    return top_k(rate_by(flights, date, cancelled(), "rate"), 1, "rate", date)


def flights_by_state_and_carrier(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights are counted per airport before they meet the airports."""
    per_airport = count_by(flights, ["destination_airport", "airline"], "flights")
    states = airports.select(F.col("iata_code").alias("destination_airport"), "state")
    return sum_by(per_airport.join(states, "destination_airport"), ["state", "airline"], "flights")


def state_delays(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """``state, avg_delay, share_delay_eq_1`` per destination state."""
    delay = F.coalesce("departure_delay", F.lit(0))
    per_airport = flights.groupBy("destination_airport").agg(
        F.sum(delay).alias("delay"), F.count_if(delay == 1).alias("ones"), F.count(F.lit(1)).alias("flights")
    )
    states = airports.select(F.col("iata_code").alias("destination_airport"), "state")
    return per_airport.join(states, "destination_airport").groupBy("state").agg(
        ratio(F.sum("delay"), F.sum("flights")).alias("avg_delay"),
        ratio(F.sum("ones"), F.sum("flights")).alias("share_delay_eq_1"),
    )


def worst_state(flights: DataFrame, airports: DataFrame) -> DataFrame:
    return top_k(state_delays(flights, airports), 1, "avg_delay", ["state"])
