import pytest

from sparkkit.plans import customers, flights, taxi
from sparkkit.sources import delimited, schemas

TRIPS = """M1,D1,2013-01-01 17:05:00,x,600,2.0,x,x,x,x,CRD,10.0,1.0,x,2.0,0.0,13.0
M1,D2,2013-01-01 18:05:00,x,0,2.0,x,x,x,x,CSH,10.0,1.0,x,0.0,0.0,11.0
M2,D1,2013-01-01 17:30:00,x,300,0,x,x,x,x,CSH,5.0,1.0,x,0.0,0.0,6.0
M2,D1,2013-01-01 17:30:00,x,300,nan,x,x,x,x,CSH,5.0,1.0,x,0.0,0.0,6.0
M2,D1,2013-01-01 17:30:00,x,300,1.5,x,x,x,x,,5.0,1.0,x,0.0,0.0,6.0
M2,D1,2013-01-01 17:30:00,x,300,1.5
M3,D3,2013-01-01 17:40:00,x,1200,4.0,x,x,x,x,CSH,20.0,0.5,x,3.0,5.0,30.0
M3,D4,2013-01-01 09:40:00,x,60,1.0,x,x,x,x,DIS,20.0,0.0,x,50.0,5.0,30.0
"""


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("trips") / "t.csv"
    path.write_text(TRIPS)
    return delimited.read_trips(spark, str(path)).cache()


def test_trip_questions(trips):
    assert trips.count() == 7
    assert [tuple(r) for r in taxi.taxis_by_drivers(trips).collect()] == [("M1", 2), ("M3", 2)]
    minute = [tuple(r) for r in taxi.drivers_by_money_per_minute(trips).collect()]
    assert minute == [("D4", 30.0), ("D3", 1.5), ("D1", 1.3)]
    hours = [tuple(r) for r in taxi.surcharge_by_hour(trips).collect()]
    assert hours == [(18, 0.5), (17, 1.5 / 6), (9, 0.0)]
    shares = taxi.payment_shares(trips).first()
    assert shares.cash == pytest.approx(100 / 3) and shares.card == pytest.approx(100 / 3)
    assert {r.hour: r.share for r in taxi.card_share_by_hour(trips).collect()} == {17: 50.0, 9: 0.0}
    assert [tuple(r) for r in taxi.drivers_by_money_per_mile(trips).collect()] == [("D4", 30.0), ("D3", 7.5), ("D1", 6.5)]
    assert tuple(taxi.tip_quartiles(trips).first()) == (2.5, 26.5)
    assert taxi.tip_outliers(trips).count() == 0
    line = taxi.fare_line(trips).first()
    assert line.n == 1 and line.slope is None
    assert len(taxi.fare_descent(trips, rounds=3).trace) == 3
    assert len(taxi.total_descent(trips, rounds=3).weights) == 5


def test_typed_and_text_trips_agree(trips, rows):
    typed = delimited.cast_columns(
        trips, {n: "double" for n in ("trip_time_in_secs", "trip_distance", "fare_amount", "surcharge", "tip", "total_amount")}
    )
    for plan in (taxi.taxis_by_drivers, taxi.drivers_by_money_per_minute, taxi.surcharge_by_hour, taxi.card_share_by_hour):
        assert rows(plan(typed)) == rows(plan(trips))


def star(spark):
    """Nation 1 and 2; customer 1 buys abroad only, 2 both, 3 nothing, 4 at home."""
    customer = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 2)], "custkey long, nationkey int")
    orders = spark.createDataFrame([(10, 1), (20, 2), (30, 4), (40, 2)], "orderkey long, custkey long")
    lines = [(10, 100, 7, 5), (10, 100, 7, 1), (10, 101, 7, 1), (20, 100, 7, 2), (20, 101, 8, 2), (30, 102, 7, 9), (99, 5, 8, 1)]
    lineitem = spark.createDataFrame(lines, "orderkey long, partkey long, suppkey long, quantity int")
    supplier = spark.createDataFrame([(7, 2), (8, 1)], "suppkey long, nationkey int")
    return customer, orders, lineitem, supplier


def test_order_questions(spark, rows):
    customer, orders, lineitem, supplier = star(spark)
    assert [tuple(r) for r in customers.top_parts(lineitem, 3).collect()] == [(100, 3), (101, 2), (5, 1)]
    assert [tuple(r) for r in customers.top_customers(orders, lineitem).collect()] == [(4, 9), (1, 7), (2, 4)]
    assert [tuple(r) for r in customers.top_customer_suppliers(orders, lineitem, 2).collect()] == [(1, 7, 3), (2, 7, 1)]
    assert rows(customers.foreign_only_customers(customer, orders, lineitem, supplier)) == [(1,)]
    assert [tuple(r) for r in customers.top_nations(lineitem, supplier).collect()] == [(2, 5), (1, 2)]
    assert [tuple(r) for r in customers.co_bought_parts(orders, lineitem).collect()] == [(100, 101, 3)]
    assert [tuple(r) for r in customers.co_bought_parts(orders, lineitem, distinct=True).collect()] == [(100, 101, 2)]
    assert rows(customers.lines_per_order(orders, lineitem)) == [(10, 1, 3), (20, 1, 2), (30, 1, 1), (40, 1, 0), (99, 0, 1)]
    assert [tuple(r) for r in customers.similar_customers(orders, lineitem, 10, 2).collect()] == [(1, 2, 1.0)]


FLIGHTS = [
    # year, month, day, day_of_week, airline, origin, destination, delay, cancelled
    (2015, 1, 2, 5, "AA", "JFK", "LAX", 30, "0"),
    (2015, 1, 3, 6, "AA", "JFK", "LAX", 1, "0"),
    (2015, 1, 4, 7, "BB", "SFO", "JFK", 50, "0"),
    (2015, 2, 4, 3, "BB", "SFO", "JFK", 0, "1"),
    (2015, 2, 4, 3, "AA", "LAX", "QQQ", 100, "0"),
    (2015, 2, 5, 4, "CC", "LAX", "SFO", None, "1"),
]
NAMES = "year int, month int, day int, day_of_week int, airline string, origin_airport string, destination_airport string, departure_delay int, cancelled string"


def test_flight_questions(spark, rows):
    df = spark.createDataFrame(FLIGHTS, NAMES).repartition(3)
    airports = spark.createDataFrame([("JFK", "NY"), ("LAX", "CA"), ("SFO", "CA")], "iata_code string, state string")
    assert rows(flights.origins(df)) == [("JFK",), ("LAX",), ("SFO",)]
    assert flights.routes(df).count() == 4
    assert flights.worst_airport_in_january(df).first().origin_airport == "SFO"
    assert flights.worst_carrier_on_weekends(df).first().airline == "BB", "Sunday counts"
    assert tuple(flights.most_cancelled_airport(df).first()) == ("LAX", 1)
    assert rows(flights.cancel_ratio(df)) == [("AA", 0.0), ("BB", 0.5), ("CC", 1.0)]
    assert rows(flights.max_delay(df)) == [("AA", 100), ("BB", 50), ("CC", None)]
    assert rows(flights.max_delay(df, "airline", "month"))[:2] == [("AA", 1, 30), ("AA", 2, 100)]
    assert rows(flights.mean_delay(df)) == [("AA", 131 / 3), ("BB", 25.0), ("CC", 0.0)]
    assert rows(flights.mean_delay(df, missing="ignore"))[-1] == ("CC", None)
    with pytest.raises(ValueError):
        flights.mean_delay(df, missing="other")
    assert tuple(flights.worst_cancel_date(df).first()) == (2015, 2, 5, 1.0)
    assert rows(flights.flights_by_state_and_carrier(df, airports)) == [("CA", "AA", 2), ("CA", "CC", 1), ("NY", "BB", 2)]
    assert rows(flights.state_delays(df, airports)) == [("CA", 31 / 3, 1 / 3), ("NY", 25.0, 0.0)]
    assert flights.worst_state(df, airports).first().state == "NY"


def test_schemas_hold_the_columns():
    assert len(schemas.TRIP.names) == 17 and len(schemas.LINEITEM.names) == 16 and len(schemas.FLIGHT.names) == 13
    sizes = [len(s.names) for s in (schemas.CUSTOMER, schemas.ORDERS, schemas.NATION, schemas.PART, schemas.PARTSUPP, schemas.REGION, schemas.SUPPLIER)]
    assert sizes == [8, 9, 4, 9, 5, 3, 6]
