"""The item pairs most often held by the same owner, exactly and without large-group joins.

The count of a pair is the sum over owners of the product of the two item counts, so it is at most the product of
the norms of the items' counts. Pairs are formed through owners from small to large (``pairs.top_pairs``): in an owner with very many items
only between those whose norms over the larger owners can still pass the bar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.operators.grouping import count_by
from sparkkit.operators.pairs import top_pairs


def owner_items(rows: DataFrame, owner: str, item: str, distinct: bool = False) -> DataFrame:
    """``owner, item, n``; with ``distinct`` repeat purchases count once."""
    named = rows.select(F.col(owner).alias("owner"), F.col(item).alias("item")).dropna()
    counts = count_by(named, ["owner", "item"], "n")
    return counts.withColumn("n", F.lit(1).cast("bigint")) if distinct else counts


class Products:
    """Items as x, owners as keys; ``rest`` is the norm of an item's counts. Counts are whole numbers, so half of one is room enough."""

    def amount(self) -> Column:
        return F.sum(F.col("w").cast("double") * F.col("w"))

    def rest(self, total: Column) -> Column:
        return F.sqrt(total)

    def hopeful(self, bar: float, most: float, strict: bool) -> Column:
        reach = F.col("rest") * F.lit(most)
        return reach > bar + 0.5 if strict else reach >= bar - 0.5

    def fitting(self, bar: float) -> Column:
        return F.lit(True)

    def score(self, shared: Column) -> Column:
        return shared

    def reach(self, shared: Column, rest_a: Column, rest_b: Column) -> Column:
        return shared + rest_a * rest_b

    def reaches(self, score: Column, bar: float, strict: bool) -> Column:
        return score > bar + 0.5 if strict else score >= bar - 0.5

    def heads(self) -> list[Column]:
        return [F.desc("w")]


def pair_counts(rows: DataFrame, owner: str, item: str, k: int = 10, distinct: bool = False) -> DataFrame:
    """``a, b, num`` of the ``k`` pairs with the largest count; ties go by ``a``, then ``b``."""
    held = owner_items(rows, owner, item, distinct)
    entries = held.select(F.col("item").alias("x"), F.col("owner").alias("key"), F.col("n").alias("w"), F.lit(0).alias("n"))
    found = top_pairs(entries, Products(), k)
    return found.select("a", "b", F.col("score").cast("bigint").alias("num"))
