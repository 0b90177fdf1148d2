"""Schemas of the input files, all strings on read and cast afterwards."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def text_schema(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


# Field order of the input files. Fields without a known meaning
# are numbered by their position.
TRIP = text_schema(
    "medallion", "hack_license", "pickup_datetime", "field_3", "trip_time_in_secs", "trip_distance",
    "field_6", "field_7", "field_8", "field_9", "payment_type", "fare_amount", "surcharge", "field_13",
    "tip", "tolls", "total_amount",
)
CATEGORY_LINK = text_schema("doc_id", "category")
CUSTOMER = text_schema("custkey", "name", "address", "nationkey", "phone", "acctbal", "mktsegment", "comment")
ORDERS = text_schema(
    "orderkey", "custkey", "orderstatus", "totalprice", "orderdate", "orderpriority", "clerk",
    "shippriority", "comment",
)
LINEITEM = text_schema(
    "orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice", "discount", "tax",
    "returnflag", "linestatus", "shipdate", "commitdate", "receiptdate", "shipinstruct", "shipmode",
    "comment",
)
NATION = text_schema("nationkey", "name", "regionkey", "comment")
PART = text_schema("partkey", "name", "mfgr", "brand", "type", "size", "container", "retailprice", "comment")
PARTSUPP = text_schema("partkey", "suppkey", "availqty", "supplycost", "comment")
REGION = text_schema("regionkey", "name", "comment")
SUPPLIER = text_schema("suppkey", "name", "address", "nationkey", "phone", "comment")
AIRPORT = text_schema("iata_code", "airport", "city", "state", "country", "latitude", "longitude")
FLIGHT = text_schema(
    "year", "month", "day", "day_of_week", "airline", "flight_number", "tail_number", "origin_airport",
    "destination_airport", "scheduled_departure", "departure_time", "departure_delay", "cancelled",
)
# Positions of FLIGHT's columns in a source line.
FLIGHT_POSITIONS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 24)
