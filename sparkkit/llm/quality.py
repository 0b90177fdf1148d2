"""Quality by weak supervision: rules vote or abstain, a mixture of two classes weighs them.

Everything runs as built-in column functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import SPACE, stored
from sparkkit.session import materialize

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Votes for good text if ``low`` <= value <= ``high``, for bad text outside ``least``..``most``, and abstains between."""

    name: str
    value: str
    low: float
    high: float
    least: float = -math.inf
    most: float = math.inf

    def vote(self) -> Column:
        value = F.expr(self.value)
        bad = F.lit(False)
        if self.least > -math.inf:
            bad = bad | (value < self.least)
        if self.most < math.inf:
            bad = bad | (value > self.most)
        good = (value >= self.low) if self.low > -math.inf else F.lit(True)
        good = good & (value <= self.high) if self.high < math.inf else good
        return F.coalesce(F.when(bad, -1).when(good, 1), F.lit(0)).cast("int").alias(f"vote_{self.name}")


#: The rules, over the measures of ``measured``; ``per_word`` values divide by the words (one at least).
RULES = (
    Rule("length", "n_words", 100, math.inf, least=50),
    Rule("repetition", "n_repeat_words / words", -math.inf, 0.1, most=0.3),
    Rule("symbols", "n_symbols / words", -math.inf, 0.02, most=0.2),
    Rule("lines", "n_dup_lines / greatest(n_lines, 1)", -math.inf, 0.05, most=0.4),
    Rule("word_length", "word_chars / words", 3.5, 7.0, least=2.5, most=10.0),
    Rule("capitals", "n_capitals / chars", -math.inf, 0.1, most=0.4),
    Rule("exclamations", "n_exclamations / words", -math.inf, 0.02, most=0.3),
    Rule("sentences", "n_stops / words", 0.02, 0.35, least=0.005, most=1.0),
    Rule("letters", "n_letters / chars", 0.9, math.inf, least=0.75),
)


def measured(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` and the measures of every whole text (null: empty); other columns are left out.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words are those of the contract.
    Windows of three words are compared by a 64-bit hash inside one text; only texts in which
    a hash occurs twice are sorted to find where.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*[F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)], text.alias("text"))
    rows = rows.withColumn("flat", F.regexp_replace("text", f"{SPACE}+", " "))
    names = [f"carry_{k}" for k in range(len(carry))]
    rows = rows.select(
        *names,
        F.expr("filter(split(trim(flat), ' '), w -> w != '')").alias("w"),
        F.length(F.replace("flat", F.lit(" "), F.lit(""))).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("flat", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("flat", r"\P{Lu}+", "")).cast("bigint").alias("n_capitals"),
        F.length(F.regexp_replace("flat", r"\P{L}+", "")).cast("bigint").alias("n_letters"),
        F.length(F.regexp_replace("flat", r"[^.!?]+", "")).cast("bigint").alias("n_stops"),
        F.length(F.regexp_replace("flat", r"[^!]+", "")).cast("bigint").alias("n_exclamations"),
        F.expr(r"filter(split(text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
    )
    measures = ["word_chars", "n_symbols", "n_capitals", "n_letters", "n_stops", "n_exclamations"]
    rows = rows.select(
        *names, *measures, F.size("w").cast("bigint").alias("n_words"), F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr("CASE WHEN size(w) > 3 THEN transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END").alias("h"),
    )
    measures += ["n_words", "n_lines", "n_dup_lines"]
    rows = rows.select(
        *names, *measures,
        F.expr("CASE WHEN size(array_distinct(h)) < size(h) THEN sort_array(transform(h, (x, i) -> struct(x AS x, i AS i))) END").alias("s"),
    )
    rows = rows.select(
        *names, *measures,
        F.expr(
            "transform(filter(sequence(0, size(s) - 1), k -> (k > 0 AND s[k].x = s[greatest(k - 1, 0)].x) "
            "OR (k + 1 < size(s) AND s[k].x = s[least(k + 1, size(s) - 1)].x)), k -> s[k].i)"
        ).alias("at"),
    )
    return rows.select(
        *[F.col(f"carry_{k}").alias(c) for k, c in enumerate(carry)], *measures,
        F.coalesce(F.expr("size(array_distinct(flatten(transform(at, i -> array(i, i + 1, i + 2)))))"), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def _weight(votes: Column, good: Column, bad: Column) -> Column:
    return F.when(votes == 1, good).when(votes == -1, bad).otherwise(F.lit(0.0))


def _score(names: list[str], prior: float, right: dict[str, tuple[float, float]]) -> Column:
    """Posterior probability of the good class: a sum of log ratios through the logistic function."""
    total = F.lit(math.log(prior / (1 - prior)))
    for name in names:
        good, bad = right[name]
        total = total + _weight(F.col(name), F.lit(math.log(good / (1 - bad))), F.lit(math.log((1 - good) / bad)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def learn(patterns: DataFrame, names: list[str], rounds: int = 40, tolerance: float = 1e-4) -> tuple[float, dict[str, tuple[float, float]]]:
    """Expectation-maximisation over counted vote patterns (columns ``names`` and ``count``).

    Returns the share of good texts and, for each rule, how often a vote of its is right on good
    and on bad texts; abstaining says nothing. One observation of a right and of a wrong vote
    is added to each, and no estimate exceeds 0.999. The start: a rule hardly ever speaks
    against good text, and any one rule sees only some of the faults of bad text. A round is one
    aggregate of at most 3^rules rows, and only its sums come to the driver.
    """
    prior, right = 0.7, {name: (0.999, 0.3) for name in names}
    good, bad = F.col("count") * F.col("p"), F.col("count") * (1 - F.col("p"))
    for _ in range(rounds):
        sums = [F.sum(good).alias("good"), F.sum(bad).alias("bad")]
        for name in names:
            vote = F.col(name)
            sums += [
                F.sum(F.when(vote == 1, good).otherwise(0.0)).alias(f"{name}_gr"), F.sum(F.when(vote == -1, good).otherwise(0.0)).alias(f"{name}_gw"),
                F.sum(F.when(vote == -1, bad).otherwise(0.0)).alias(f"{name}_br"), F.sum(F.when(vote == 1, bad).otherwise(0.0)).alias(f"{name}_bw"),
            ]
        row = patterns.withColumn("p", _score(names, prior, right)).agg(*sums).first()
        if row.good is None:
            break
        before = (prior, *[x for pair in right.values() for x in pair])
        prior = (row.good + 1) / (row.good + row.bad + 2)
        right = {
            n: tuple(min((row[f"{n}_{c}r"] + 1) / (row[f"{n}_{c}r"] + row[f"{n}_{c}w"] + 2), 0.999) for c in "gb") for n in names
        }
        if max(abs(a - b) for a, b in zip(before, (prior, *[x for pair in right.values() for x in pair]))) < tolerance:
            break
    return prior, right


def assess(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``carry``, the measures, the votes, ``base_failed``, ``posterior`` and ``kept`` of every row.

    ``base_failed``: under 50 words, or more than half of the words in repeated windows. ``kept``:
    not so, and the posterior of good text reaches ``threshold``. Null and empty texts fail.
    Repeated rows are judged each. An empty table stays empty. Measures are taken once and
    stored in the shared folder; the vote patterns are counted from there. The two classes are
    learned from the texts that pass the base test: what fails it is decided already, and is
    so common a fault that it would claim the class of bad texts for itself. ``carry`` must not hold
    the name of a measure; columns that it doesn't name are left out whatever their names.
    """
    names = [f"vote_{r.name}" for r in rules]
    rows = measured(docs, carry)
    based = rows.withColumns({"words": F.greatest("n_words", F.lit(1)), "chars": F.greatest("word_chars", F.lit(1))})
    kept = [c for c in rows.columns]
    measures = stored(based.select(*kept, *[r.vote() for r in rules]), "measures")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    patterns = materialize(measures.filter(~failed).groupBy(*names).agg(F.count(F.lit(1)).alias("count")), "patterns")
    prior, right = learn(patterns, names)
    return measures.select("*", failed.alias("base_failed"), _score(names, prior, right).alias("posterior")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    )
