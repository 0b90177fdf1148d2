"""The most similar pairs of item sets, by Jaccard similarity, exactly.

A first look at min-hash neighbours gives k real similarities; the lowest of them is a bar no result can fall under. Pairs are then formed
through items from rare to common (``pairs.top_pairs``), only where they can still pass the bar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkkit.functions.scalars import ratio
from sparkkit.operators.pairs import Bar, top_pairs
from sparkkit.session import materialize

SIGNATURES = 4
SEED_PAIRS = 1000
_ROOM = 1e-9


def item_sets(rows: DataFrame, owner: str, item: str) -> DataFrame:
    """Distinct (x, item) rows."""
    return rows.select(F.col(owner).alias("x"), F.col(item).alias("item")).dropna().distinct()


def _described(sets: DataFrame) -> DataFrame:
    """Per set its size, a 128-bit content print and its min-hash signatures."""
    hashes = [F.min(F.xxhash64(F.lit(i), "item")).alias(f"s{i}") for i in range(SIGNATURES)]
    return sets.groupBy("x").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(F.lit("a"), "item")).alias("print_a"),
        F.bit_xor(F.xxhash64(F.lit("b"), "item")).alias("print_b"),
        *hashes,
    )


def _first_copies(described: DataFrame, k: int) -> DataFrame:
    """At most k+1 sets of identical content, those with the smallest keys.

    Pairs rank by similarity and then by keys, so a later copy always has k pairs
    with the earlier copies ranked before any pair of its own.
    """
    order = Window.partitionBy("n", "print_a", "print_b").orderBy("x")
    return described.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= k + 1).drop("copy")


def _seed_pairs(described: DataFrame) -> DataFrame:
    """Pairs likely to be similar: the two outer members of each signature group, best agreement first."""
    signatures = [f"s{i}" for i in range(SIGNATURES)]
    hashed = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(s).alias("s")) for i, s in enumerate(signatures))))
    outer = (
        described.select("x", hashed.alias("h"))
        .groupBy("h")
        .agg(F.min("x").alias("a"), F.max("x").alias("b"))
        .where("a < b")
    )
    pairs = outer.groupBy("a", "b").agg(F.count(F.lit(1)).alias("agree"))
    return pairs.orderBy(F.desc("agree"), "a", "b").limit(SEED_PAIRS).select("a", "b")


def _jaccard(common: Column) -> Column:
    return ratio(common, F.col("na") + F.col("nb") - common)


def _bar(sets: DataFrame, described: DataFrame, k: int) -> Bar:
    """The k-th best seed pair, if there are k."""
    seeds = _seed_pairs(described)
    sizes = described.select("x", "n")
    a_items = sets.join(F.broadcast(seeds), sets.x == seeds.a).select("a", "b", "item")
    b_items = sets.select(F.col("x").alias("b"), "item")
    common = a_items.join(b_items, ["b", "item"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    sized = common.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    return Bar().raised(sized, _jaccard(F.col("common")), k)


class Jaccard:
    """Sets as x, items as keys; ``rest`` counts items, ``n`` is the size of a set."""

    def __init__(self, least: int):
        self.least = least

    def amount(self) -> Column:
        return F.count(F.lit(1))

    def rest(self, total: Column) -> Column:
        return total

    def hopeful(self, bar: float, most: float, strict: bool) -> Column:
        """A pair over the bar shares more than bar / (1 + bar) of its added sizes, and the other set is at least ``least`` and bar * n."""
        n = F.col("n")
        needed = (n + F.greatest(F.lit(float(self.least)), n * bar)) * bar
        return F.col("rest") * (1 + bar) > needed + _ROOM if strict else F.col("rest") * (1 + bar) >= needed - _ROOM

    def fitting(self, bar: float) -> Column:
        return F.least("na", "nb") >= F.greatest("na", "nb") * bar - _ROOM

    def score(self, shared: Column) -> Column:
        return _jaccard(shared)

    def reach(self, shared: Column, rest_a: Column, rest_b: Column) -> Column:
        return _jaccard(F.least(shared + F.least(rest_a, rest_b), F.col("na"), F.col("nb")))

    def reaches(self, score: Column, bar: float, strict: bool) -> Column:
        return score > bar if strict else score >= bar - _ROOM

    def heads(self) -> list[Column]:
        return [F.asc("n")]


def similar_pairs(rows: DataFrame, owner: str, item: str, k: int = 10, min_items: int = 10) -> DataFrame:
    """``a, b, jaccard`` of the ``k`` most similar owners with at least ``min_items`` distinct items.

    Every returned pair shares an item: when fewer than ``k`` pairs do, the result is
    shorter than ``k``. Ties go by ``a``, then ``b``.
    """
    all_sets = materialize(item_sets(rows, owner, item), "item-sets")
    described = materialize(_first_copies(_described(all_sets).where(F.col("n") >= min_items), k), "set-prints")
    chosen = all_sets.join(described.select("x", "n"), "x")
    bar = _bar(chosen.select("x", "item"), described, k)
    entries = chosen.select("x", F.col("item").alias("key"), F.lit(1).cast("bigint").alias("w"), "n")
    return top_pairs(entries, Jaccard(min_items), k, bar).withColumnRenamed("score", "jaccard")
