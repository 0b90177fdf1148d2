"""Questions over the orders star schema.

Frames carry the columns ``custkey, nationkey`` (customer), ``orderkey, custkey``
(orders), ``orderkey, partkey, suppkey, quantity`` (lineitem) and ``suppkey,
nationkey`` (supplier). Line items are reduced on their join key first where the
question allows it, so a hot key meets the join as few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.operators.copurchase import pair_counts
from sparkkit.operators.grouping import count_by, sum_by
from sparkkit.operators.ranking import top_k
from sparkkit.operators.similarity import similar_pairs


def _bought(orders: DataFrame, lineitem: DataFrame, *columns: str) -> DataFrame:
    """Customer next to the chosen columns of each of their line items."""
    lines = lineitem.select("orderkey", *columns)
    return orders.select("orderkey", "custkey").join(lines, "orderkey").drop("orderkey")


def top_parts(lineitem: DataFrame, k: int = 10) -> DataFrame:
    return top_k(count_by(lineitem, ["partkey"]), k, "num", ["partkey"])


def top_customers(orders: DataFrame, lineitem: DataFrame, k: int = 10) -> DataFrame:
    """Customers by the quantity they ordered."""
    per_order = sum_by(lineitem, ["orderkey"], "quantity", "quantity")
    return top_k(sum_by(_bought(orders, per_order, "quantity"), ["custkey"], "quantity"), k, "num", ["custkey"])


def top_customer_suppliers(orders: DataFrame, lineitem: DataFrame, k: int = 10) -> DataFrame:
    """(customer, supplier) pairs by line items."""
    pairs = count_by(_bought(orders, lineitem, "suppkey"), ["custkey", "suppkey"])
    return top_k(pairs, k, "num", ["custkey", "suppkey"])


def foreign_only_customers(
    customer: DataFrame, orders: DataFrame, lineitem: DataFrame, supplier: DataFrame
) -> DataFrame:
    """Customers with orders, none of them from a supplier of their own country."""
    pairs = _bought(orders, lineitem, "suppkey").distinct()
    home = customer.select("custkey", F.col("nationkey").alias("home"))
    source = supplier.select("suppkey", F.col("nationkey").alias("source"))
    own = F.count_if(F.col("home") == F.col("source"))
    met = pairs.join(source, "suppkey").join(home, "custkey").groupBy("custkey").agg(own.alias("own"))
    return met.where("own = 0").select("custkey")


def top_nations(lineitem: DataFrame, supplier: DataFrame, k: int = 3) -> DataFrame:
    """Supplier countries by line items."""
    per_supplier = count_by(lineitem, ["suppkey"], "lines")
    by_nation = sum_by(per_supplier.join(supplier.select("suppkey", "nationkey"), "suppkey"), ["nationkey"], "lines")
    return top_k(by_nation, k, "num", ["nationkey"])


def similar_customers(orders: DataFrame, lineitem: DataFrame, k: int = 10, min_parts: int = 10) -> DataFrame:
    """Customer pairs by Jaccard similarity of the distinct parts they bought."""
    return similar_pairs(_bought(orders, lineitem, "partkey"), "custkey", "partkey", k, min_parts)


def co_bought_parts(orders: DataFrame, lineitem: DataFrame, k: int = 10, distinct: bool = False) -> DataFrame:
    """Part pairs bought most often by the same customer."""
    return pair_counts(_bought(orders, lineitem, "partkey"), "custkey", "partkey", k, distinct)


def lines_per_order(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Line count of every order on either side; orders without lines and lines without order stay."""
    lines = count_by(lineitem, ["orderkey"], "lines")
    known = orders.select("orderkey", F.lit(1).alias("known"))
    return known.join(lines, "orderkey", "full").select(
        "orderkey", F.coalesce("known", F.lit(0)).alias("known"), F.coalesce("lines", F.lit(0)).alias("lines")
    )
