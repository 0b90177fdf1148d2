"""The best pairs of a self-join, exactly, without forming all pairs.

Entries ``x, key, w, n`` say that x holds the key with weight w; n belongs to x. Two x meet where they hold the same key, and the products of
their weights add up. Keys are taken in classes, from those that few hold to those that most hold. After every class the k best
sums so far raise a bar. An x forms pairs in a class only if its own keys from there on could still lift a pair over the bar, so what the
commonest keys would tie together is formed only where it can matter. In the end the few pairs that are near the
bar and were not followed through all classes are counted again in full. Pairs that only equal the bar matter only if
they come early in the order of ties; they are formed from the few x that are early enough. What is shuffled is lists of
partners, one for each x and key; the pairs are unfolded and added up where the lists of an x meet.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkkit.operators.ranking import top_k, top_k_per_group
from sparkkit.session import materialize, new_path

#: A class holds the keys with 2^(STEP * class) to 2^(STEP * (class + 1)) - 1 entries.
STEP = 4
#: Holders of a key in one list, about.
LIST = 256
#: Pairs that one task adds up in memory, about.
PAIRS = 1 << 21


class Measure(Protocol):
    """How sums of products become scores, and what bounds them. Comparisons must leave room for rounding."""

    def amount(self) -> Column:
        """Over the entries (``w``) of an x and class: what adds up to its ``rest``."""

    def rest(self, total: Column) -> Column:
        """From the added amounts of a class and all later ones: ``rest``, which bounds what an x can share there."""

    def hopeful(self, bar: float, most: float, strict: bool) -> Column:
        """Of an entry (``rest, n``): whether keys from its class on alone can lift a pair over the bar (``strict``), or to
        it. ``most`` is the largest ``rest`` of the class."""

    def fitting(self, bar: float) -> Column:
        """Of a pair (``na, nb``): whether it can reach the bar at all."""

    def score(self, shared: Column) -> Column:
        """Of a pair (``na, nb``) that shares so much."""

    def reach(self, shared: Column, rest_a: Column, rest_b: Column) -> Column:
        """The best score of a pair that shares so much in some classes and has these rests in the others."""

    def reaches(self, score: Column, bar: float, strict: bool) -> Column: ...

    def heads(self) -> list[Column]:
        """The order of the entries of a key, likely best pairs first."""


@dataclass
class Bar:
    """The k-th best known pair: its score and its first member; pairs of equal score that start later come after it."""

    score: float = 0.0
    first: object = None

    def raised(self, pairs: DataFrame, score: Column, k: int) -> Bar:
        best = top_k(pairs.select("a", "b", score.alias("score")), k, "score", ["a", "b"]).collect()
        if len(best) < k or best[-1].score < self.score or (best[-1].score == self.score and self.first is not None and self.first <= best[-1].a):
            return self
        return Bar(best[-1].score, best[-1].a)

    def early(self, x: str) -> Column:
        return F.lit(True) if self.first is None else F.col(x) <= F.lit(self.first)


def classed_entries(entries: DataFrame, measure: Measure) -> tuple[DataFrame, DataFrame, list[tuple[int, float, float]]]:
    """The entries whose key at least two x hold, stored by ``class``; per x and class its ``rest`` and what is ``later`` than the
    class; the classes in ascending order, each with its largest rest and the number of pairs that all its keys would form."""
    held = entries.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    classes = held.select("key", F.floor(F.log2("held") / STEP + 1e-9).cast("int").alias("class"), "held")
    path = new_path(entries.sparkSession, "entries")
    entries.select("x", "key", "w", "n").join(classes, "key").write.partitionBy("class").parquet(path)
    kinds = dict(entries.dtypes)
    stored = entries.sparkSession.read.schema(", ".join(f"{name} {kinds[name]}" for name in ("x", "key", "w", "n")) + ", held bigint, class int").parquet(path)
    per = stored.groupBy("x", "class").agg(measure.amount().alias("amount"), F.max("n").alias("n"))
    down = Window.partitionBy("x").orderBy(F.desc("class"))
    after = F.coalesce(F.sum("amount").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ladder = per.select("x", "class", "n", measure.rest(F.sum("amount").over(down)).alias("rest"), measure.rest(after).alias("later"))
    ladder = materialize(ladder, "rests")
    numbers = ladder.groupBy("class").agg(F.max("rest").alias("most")).orderBy("class").collect()
    counts = {r["class"]: r.pairs for r in stored.groupBy("class").agg((F.sum(F.col("held") - 1.0) / 2).alias("pairs")).collect()}
    return stored.drop("held"), ladder, [(r["class"], float(r.most), counts[r["class"]]) for r in numbers]


def _listed(entries: DataFrame, chunks: int, early: Column) -> DataFrame:
    """``a, chunk, na, la`` and lists ``b, shared, nb, lb``: x next to the later holders of one of its keys, some hundred of them at most on average.

    What belongs to x is stated once for all of them. ``lb`` is null where not both are strictly hopeful.
    """
    own = entries.withColumn("chunk", F.pmod(F.xxhash64("x"), F.lit(chunks)).cast("int"))
    held = own.groupBy("key", "chunk").agg(F.collect_list(F.struct("x", "w", "n", "later", "strict")).alias("held"))
    if chunks == 1:
        met = held.select("chunk", "held", F.inline("held"))
    else:
        met = entries.select("key", "x", "w", "n", "later", "strict").join(held, "key")
    kept = F.filter("held", lambda e: (e["x"] > F.col("x")) & ((F.col("strict") & e["strict"]) | early))
    met = met.select(F.col("x").alias("a"), "chunk", "w", F.col("n").alias("na"), F.col("later").alias("la"), "strict", kept.alias("held")).where(F.size("held") > 0)
    return met.select(
        "a", "chunk", "na", "la", F.col("held.x").alias("b"), F.transform("held", lambda e: F.col("w") * e["w"]).alias("shared"),
        F.col("held.n").alias("nb"), F.transform("held", lambda e: F.when(F.col("strict") & e["strict"], e["later"])).alias("lb"),
    )


def formed_pairs(entries: DataFrame, measure: Measure, bar: Bar, most: float, chunks: int = 1, parts: int = 1, known: DataFrame | None = None) -> DataFrame:
    """``a, chunk, b, shared, na, nb, la, lb``: a row for each key of a class that two hopeful x share, and what they hold later; the pairs
    ``known`` are among them.

    Pairs that could only equal the bar are not always followed; they have no ``la`` and ``lb``. All rows of a pair are in the same of
    ``parts`` partitions: lists of partners are moved there and unfolded, so that no row per pair is shuffled.
    """
    own = entries.withColumn("strict", measure.hopeful(bar.score, most, True))
    able = own.where("strict") if bar.first is None else own.where(measure.hopeful(bar.score, most, False))
    lists = _listed(able, chunks, F.lit(False) if bar.first is None else bar.early("x"))
    if known is not None:
        chunk = F.pmod(F.xxhash64("b"), F.lit(chunks)).cast("int").alias("chunk")
        lists = lists.unionByName(known.select("a", chunk, "na", "la", *(F.array(name).alias(name) for name in ("b", "shared", "nb", "lb"))))
    unfolded = F.inline(F.arrays_zip("b", "shared", "nb", "lb"))
    formed = lists.repartition(parts, "a", "chunk").select("a", "chunk", "na", F.col("la").alias("later"), unfolded)
    formed = formed.withColumn("la", F.when(F.col("lb").isNotNull(), F.col("later"))).drop("later")
    return formed.where(measure.fitting(bar.score))


def _summed(formed: DataFrame) -> DataFrame:
    summed = formed.groupBy("a", "chunk", "b").agg(
        F.sum("shared").alias("shared"), F.max("na").alias("na"), F.max("nb").alias("nb"), F.min("la").alias("la"), F.min("lb").alias("lb")
    )
    return summed.drop("chunk")


def _open_to(best: Column, measure: Measure, bar: Bar) -> Column:
    """Whether a pair with this best score can be among the k best."""
    return measure.reaches(best, bar.score, True) | (measure.reaches(best, bar.score, False) & bar.early("a"))


def _rest_from(ladder: str, start: Column) -> Column:
    """The rest of an x from a class on, read off its ladder."""
    later = F.filter(ladder, lambda step: step["class"] >= start)
    return F.coalesce(F.get(later, F.lit(0))["rest"], F.lit(0))


def top_pairs(entries: DataFrame, measure: Measure, k: int, bar: Bar | None = None) -> DataFrame:
    """``a, b, score`` of the ``k`` pairs a < b with the highest score; ties go by a, then b. Pairs share a key, so fewer may be found.

    ``entries`` (``x, key, w, n``) hold each x and key once; ``bar`` may be known from other pairs.
    """
    stored, ladder, classes = classed_entries(entries, measure)
    kind = dict(entries.dtypes)["x"]
    if not classes:
        return entries.sparkSession.createDataFrame([], f"a {kind}, b {kind}, score double")
    bar, pairs, history = bar or Bar(), None, []
    least = entries.sparkSession.sparkContext.defaultParallelism
    for number, most, count in classes:
        chunks, parts = max(1, 2 ** (STEP * (number + 1)) // LIST), max(least, int(count // PAIRS) + 1)
        of_class = F.col("class") == number
        own = stored.where(of_class).drop("class").join(ladder.where(of_class).select("x", "rest", "later"), "x")
        if 2 ** (STEP * number) >= 4 * (k + 1):  # a part of the pairs first, where it is a small part
            order = Window.partitionBy("key").orderBy(*measure.heads(), "x")
            heads = own.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place")
            bar = bar.raised(_summed(formed_pairs(heads, measure, bar, float("inf"), 1, least)), measure.score(F.col("shared")), k)
        history.append((number, bar.score, most))
        met = _summed(formed_pairs(own, measure, bar, most, chunks, parts, pairs))
        best = measure.reach(F.col("shared"), F.col("la"), F.col("lb"))
        pairs = materialize(met.where(F.col("la").isNull() | _open_to(best, measure, bar)), "met-pairs")
        bar = bar.raised(pairs, measure.score(F.col("shared")), k)
    return top_k(_finished(pairs, stored, ladder, measure, bar, history), k, "score", ["a", "b"])


def _finished(pairs: DataFrame, stored: DataFrame, ladder: DataFrame, measure: Measure, bar: Bar, history: list[tuple[int, float, float]]) -> DataFrame:
    """``a, b, score``: pairs of x that were strictly hopeful in all their classes as they are, others that can reach the bar counted in full."""
    strict = F.lit(False)
    for number, score, most in history:
        strict = F.when(F.col("class") == number, measure.hopeful(score, most, True)).otherwise(strict)
    limits = ladder.withColumn("strict", strict).groupBy("x").agg(
        F.min(F.when(~F.col("strict"), F.col("class"))).alias("cut"), F.sort_array(F.collect_list(F.struct("class", "rest"))).alias("ladder")
    )
    short = materialize(limits.where("cut IS NOT NULL").select("x", "cut"), "cuts")
    cut = pairs.join(short.toDF("a", "cut_a"), "a", "left").join(short.toDF("b", "cut_b"), "b", "left")
    cut = materialize(cut.withColumn("cut", F.least("cut_a", "cut_b")).drop("cut_a", "cut_b"), "cut-pairs")
    whole = cut.where("cut IS NULL").select("a", "b", measure.score(F.col("shared")).alias("score"))
    open_ = cut.where("cut IS NOT NULL").join(limits.select(F.col("x").alias("a"), F.col("ladder").alias("ladder_a")), "a").join(
        limits.select(F.col("x").alias("b"), F.col("ladder").alias("ladder_b")), "b"
    )
    best = measure.reach(F.col("shared"), _rest_from("ladder_a", F.col("cut")), _rest_from("ladder_b", F.col("cut")))
    near = materialize(open_.where(_open_to(best, measure, bar)).select("a", "b", "na", "nb"), "near-pairs")
    of_a = stored.select(F.col("x").alias("a"), "key", F.col("w").alias("wa"))
    of_b = stored.select(F.col("x").alias("b"), "key", F.col("w").alias("wb"))
    again = near.join(of_a, "a").join(of_b, ["b", "key"]).groupBy("a", "b").agg(
        F.sum(F.col("wa") * F.col("wb")).alias("shared"), F.max("na").alias("na"), F.max("nb").alias("nb")
    )
    return whole.unionByName(again.select("a", "b", measure.score(F.col("shared")).alias("score")))
