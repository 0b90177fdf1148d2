"""Questions over taxi trips as read by ``read_trips``; measures may be text or already typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.functions.cleaning import REGRESSION_BOUNDS, complete, non_zero, number, within
from sparkkit.functions.scalars import hour_of
from sparkkit.operators.grouping import distinct_by, rate_by, ratio_by, share_of_rows
from sparkkit.operators.quantiles import fence_outliers, quartiles
from sparkkit.operators.ranking import top_k
from sparkkit.operators.regression import Descent, descend, fit_line, gram
from sparkkit.sources.schemas import TRIP

# The two payment codes.
CASH, CARD = "CSH", "CRD"


def valid_trips(trips: DataFrame, timed: bool = False) -> DataFrame:
    """Complete trips with non-zero distance and fare, and with ``timed`` a non-zero time."""
    measures = ["trip_distance", "fare_amount"] + (["trip_time_in_secs"] if timed else [])
    return trips.where(non_zero(measures) & complete(trips, TRIP.names))


def regression_trips(trips: DataFrame) -> DataFrame:
    """Trips inside the bounds used for regression."""
    return trips.where(within(REGRESSION_BOUNDS))


def taxis_by_drivers(trips: DataFrame, k: int = 10) -> DataFrame:
    drivers = distinct_by(valid_trips(trips), ["medallion"], "hack_license", "drivers")
    return top_k(drivers, k, "drivers", ["medallion"])


def drivers_by_money_per_minute(trips: DataFrame, k: int = 10) -> DataFrame:
    minutes = number("trip_time_in_secs") / 60
    paid = ratio_by(valid_trips(trips, timed=True), ["hack_license"], number("total_amount"), minutes, "per_minute")
    return top_k(paid, k, "per_minute", ["hack_license"])


def surcharge_by_hour(trips: DataFrame) -> DataFrame:
    hourly = valid_trips(trips).withColumn("hour", hour_of("pickup_datetime"))
    rates = ratio_by(hourly, ["hour"], number("surcharge"), number("trip_distance"), "per_mile")
    return rates.orderBy(F.desc("per_mile"), "hour")


def payment_shares(trips: DataFrame) -> DataFrame:
    kind = F.col("payment_type")
    return share_of_rows(valid_trips(trips, timed=True), {"cash": kind == CASH, "card": kind == CARD})


def card_share_by_hour(trips: DataFrame) -> DataFrame:
    """Percent of trips paid by card for every hour; an hour without card trips has 0."""
    hourly = valid_trips(trips, timed=True).withColumn("hour", hour_of("pickup_datetime"))
    rates = rate_by(hourly, ["hour"], F.col("payment_type") == CARD, "share")
    return rates.withColumn("share", F.col("share") * 100)


def drivers_by_money_per_mile(trips: DataFrame, k: int = 10) -> DataFrame:
    paid = ratio_by(
        valid_trips(trips, timed=True), ["hack_license"], number("total_amount"), number("trip_distance"), "per_mile"
    )
    return top_k(paid, k, "per_mile", ["hack_license"])


def _tips(trips: DataFrame) -> DataFrame:
    return valid_trips(trips, timed=True).select(number("tip").alias("tip"))


def tip_quartiles(trips: DataFrame) -> DataFrame:
    return quartiles(_tips(trips), "tip")


def tip_outliers(trips: DataFrame, k: int = 10) -> DataFrame:
    """Tips farthest outside the quartile fences."""
    return top_k(fence_outliers(_tips(trips), "tip"), k, "gap", ["tip"])


def fare_line(trips: DataFrame) -> DataFrame:
    """Least-squares line of the fare on the distance."""
    return fit_line(regression_trips(trips), number("trip_distance"), number("fare_amount"))


def fare_descent(trips: DataFrame, start: float = 0.1, rate: float = 1e-4, rounds: int = 100, digits: int = 2) -> Descent:
    """Fare on the distance. The sums are rounded, as their last digits depend on the order of rows."""
    sums = gram(regression_trips(trips), [number("trip_distance")], number("fare_amount"))
    return descend(sums.round(digits), start, rate, rounds)


def total_descent(trips: DataFrame, start: float = 0.1, rate: float = 1e-3, rounds: int = 100, digits: int = 2) -> Descent:
    """Total amount on minutes, miles, fare and surcharge; sums are rounded as in ``fare_descent``."""
    features = [
        number("trip_time_in_secs") / 60, number("trip_distance"), number("fare_amount"), number("surcharge"),
    ]
    return descend(gram(regression_trips(trips), features, number("total_amount")).round(digits), start, rate, rounds)
