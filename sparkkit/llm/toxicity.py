"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import slices, small_batches, stored, texts_of

#: Letters of other scripts that look like Latin ones, and digits or signs written for letters.
LOOKALIKES = "аa еe оo рp сc уy хx іi ѕs јj ԁd һh ѵv ԛq αa εe οo ρp τt υu νv ιi κk ıi"
SUBSTITUTES = "0o 1i 3e 4a 5s 7t @a $s"

_FOLD = {ord(c): " " for c in string.punctuation + string.whitespace + "«»„“”‘’…–—¿¡"}
_FOLD |= {0x200B: None, 0x200C: None, 0x200D: None, 0xAD: None}
_FOLD |= {ord(pair[0]): pair[1] for pair in (LOOKALIKES + " " + SUBSTITUTES).split()}
_PREFIXES = range(4, 8)


def fold_text(text: str) -> str:
    """Lower case, lookalikes and substitutes as plain letters, punctuation and white space as spaces, a space at both ends."""
    return f" {text.lower().translate(_FOLD)} "


@dataclass
class Lexicon:
    """Entries with weights. ``' word '`` matches a whole word, ``' start'`` words that begin so; exceptions cancel entries inside them."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    #: Of the logistic: bias, log of the summed weights, weights per 100 words.
    curve: tuple[float, float, float] = (-4.0, 1.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight, entry))
        for phrase in self.exceptions:
            if phrase not in self.weights:
                found.add_word(phrase, (len(phrase), 0.0, phrase))
        if len(found):
            found.make_automaton()
        return found


def matches(folded: str, automaton: ahocorasick.Automaton, exceptions: frozenset[str]) -> list[tuple[int, int, float, str]]:
    """Begin, end, weight and entry of each match that no exception covers; of the matches that begin at one place, the weightiest."""
    if not len(automaton):
        return []
    best: dict[int, tuple[int, int, float, str]] = {}
    covers = []
    for end, (size, weight, entry) in automaton.iter(folded):
        begin = end + 1 - size
        if entry in exceptions:
            covers.append((begin, end))
        elif begin not in best or best[begin][2] < weight:
            best[begin] = (begin, end, weight, entry)
    if not covers:
        return list(best.values())
    return [m for m in best.values() if not any(a <= m[0] and m[1] <= b for a, b in covers)]


def signals(folded: str, found: list[tuple[int, int, float, str]]) -> tuple[float, float]:
    """Log of one plus the summed weights, and the weights per 100 words (20 words at least)."""
    if not found:
        return 0.0, 0.0
    total = sum(m[2] for m in found)
    return math.log1p(total), 100.0 * total / max(20, len(folded.split()))


def _features(folded: str) -> set[str]:
    """Whole words and word beginnings of a folded text, as lexicon entries."""
    words = set(folded.split())
    return {f" {w} " for w in words if 2 < len(w) <= 30} | {f" {w[:k]}" for w in words for k in _PREFIXES if k < len(w)}


def fit(labelled: DataFrame, max_docs: int = 10_000, max_entries: int = 2000, least_docs: int = 4) -> Lexicon:
    """Learns the lexicon from rows (doc_id, text, toxic); null texts are empty, null labels left out.

    ``labelled`` should hold about ``max_docs`` rows (see ``sample_labelled``); it is stored
    once and read several times. Entries seen in at least ``least_docs`` toxic rows and far more often there than in others are
    candidates, the ``max_entries`` commonest of them are kept; then the fewest that together
    occur in the toxic rows are chosen one by one, so words that merely stand in copies of a
    toxic text don't enter. A phrase of an entry and a neighbouring word that occurs only in
    rows that are not toxic, three times or more, becomes an exception. Last, a logistic curve
    over the summed weights and the weights per 100 words is fitted. What comes to the driver is
    bounded by ``max_docs`` and ``max_entries``.
    """
    small_batches(labelled)
    rows = labelled.filter("toxic IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    rows = stored(rows, "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches):
            by = [Counter(), Counter()]
            for text, toxic in zip(block.column("text").to_pylist(), block.column("toxic").to_pylist()):
                by[int(toxic == 1)].update(_features(fold_text(text)))
            names = list(by[0].keys() | by[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([by[1][x] for x in names], pa.int64()), pa.array([by[0][x] for x in names], pa.int64())], ["entry", "toxic", "clean"])

    sizes = {r.toxic == 1: r["count"] for r in rows.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic:
        return Lexicon()
    counts = rows.mapInArrow(count, "entry string, toxic bigint, clean bigint").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    candidates = (
        counts.filter(F.col("toxic") >= least_docs).withColumn("odds", odds).filter(F.col("odds") >= 2.5)
        .orderBy(F.desc("toxic"), F.desc("odds"), "entry").limit(max_entries).collect()
    )
    weights = {r.entry: r.odds for r in candidates}
    chosen = _cover(weights, _incidence(rows, weights))
    exceptions = _exceptions(rows, chosen)
    return Lexicon(chosen, exceptions, _curve(rows, chosen, exceptions))


def _incidence(rows: DataFrame, weights: dict[str, float]) -> list[list[str]]:
    """The candidates in each toxic row."""
    known = frozenset(weights)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([sorted(_features(fold_text(t)) & known) for t in block.column("text").to_pylist()], pa.list_(pa.string()))], ["entries"])

    return [r.entries for r in rows.filter("toxic = 1").mapInArrow(find, "entries array<string>").collect()]


def _cover(weights: dict[str, float], held: list[list[str]], least: int = 3) -> dict[str, float]:
    """Greedy cover of the rows by entries: next comes the entry with most rows not yet covered times its weight."""
    by_entry: dict[str, set[int]] = {}
    for k, entries in enumerate(held):
        for entry in entries:
            by_entry.setdefault(entry, set()).add(k)
    chosen: dict[str, float] = {}
    covered = Counter()
    times = 2  # each row by two entries, where it has them: any one may be missing from other rows
    while by_entry:
        open_rows = {e: sum(covered[k] < times for k in rows) for e, rows in by_entry.items()}
        entry = max(by_entry, key=lambda e: (open_rows[e] * weights[e], weights[e], e))
        if open_rows[entry] < least:
            break
        chosen[entry] = weights[entry]
        covered.update(by_entry.pop(entry))
    return chosen


def _exceptions(rows: DataFrame, chosen: dict[str, float]) -> tuple[str, ...]:
    automaton_of = Lexicon(chosen)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of.automaton()
        for block in slices(batches):
            by = [Counter(), Counter()]
            for text, toxic in zip(block.column("text").to_pylist(), block.column("toxic").to_pylist()):
                folded = re.sub(" +", " ", fold_text(text))
                phrases = set()
                for begin, end, *_ in matches(folded, automaton, frozenset()):
                    stop = folded.find(" ", begin + 1)
                    left, right = folded.rfind(" ", 0, begin), folded.find(" ", stop + 1)
                    if left >= 0:
                        phrases.add(folded[left : stop + 1])
                    if right > 0:
                        phrases.add(folded[begin : right + 1])
                by[int(toxic == 1)].update(phrases)
            names = list(by[0].keys() | by[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([by[1][x] for x in names], pa.int64()), pa.array([by[0][x] for x in names], pa.int64())], ["phrase", "toxic", "clean"])

    if not chosen:
        return ()
    counts = rows.mapInArrow(around, "phrase string, toxic bigint, clean bigint").groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return tuple(sorted(r.phrase for r in counts.filter("toxic = 0 AND clean >= 3").orderBy(F.desc("clean"), "phrase").limit(1000).collect()))


def _curve(rows: DataFrame, chosen: dict[str, float], exceptions: tuple[str, ...]) -> tuple[float, float, float]:
    """Logistic regression on the two signals by Newton's method, over gathered (signal, signal, label) rows."""
    lexicon = Lexicon(chosen, exceptions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, covers = lexicon.automaton(), frozenset(lexicon.exceptions)
        for block in slices(batches):
            pairs = [signals(t, matches(t, automaton, covers)) for t in map(fold_text, block.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]), block.column("toxic")], ["a", "b", "toxic"])

    found = rows.mapInArrow(run, "a double, b double, toxic int").collect()
    x = np.array([(1.0, r.a, r.b) for r in found])
    y = np.array([float(r.toxic == 1) for r in found])
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (y - p) - 1e-2 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        w = w + np.linalg.solve(bend, slope)
    return float(w[0]), float(w[1]), float(w[2])


def sample_labelled(docs: DataFrame, labels: DataFrame, max_docs: int = 10_000) -> DataFrame:
    """About ``max_docs`` rows (doc_id, text, toxic), chosen by a hash of doc_id before the tables are joined."""
    share = min(1.0, max_docs / max(1, labels.count()))

    def drawn(df):
        return df.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)

    return drawn(docs.select("doc_id", "text")).join(drawn(labels.select("doc_id", "toxic")).hint("merge"), "doc_id")


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``score`` (0 to 1), ``predicted`` (1: toxic), ``found`` (all distinct entries) of every whole text, and the columns ``more``.

    Null and empty texts have no match and the lowest score. Repeated rows are scored each, an
    empty table stays empty, columns not named are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, covers = lexicon.automaton(), frozenset(lexicon.exceptions)
        bias, by_sum, by_length = lexicon.curve
        for block in slices(batches):
            scores, found = [], []
            for text in block.column("text").to_pylist():
                folded = fold_text(text)
                here = matches(folded, automaton, covers)
                a, b = signals(folded, here)
                z = max(-500.0, min(500.0, bias + by_sum * a + by_length * b))
                scores.append(1 / (1 + math.exp(-z)))
                found.append(sorted({m[3] for m in here}))
            columns = [block.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, *(block.column(f"more_{k}") for k in range(len(more)))], ["doc_id", "score", "predicted", "found", *(f"more_{k}" for k in range(len(more)))])

    rows = texts_of(docs, *[F.col(c).alias(f"more_{k}") for k, c in enumerate(more)])
    kinds = dict(rows.dtypes)
    schema = "doc_id bigint, score double, predicted int, found array<string>" + "".join(f", more_{k} {kinds[f'more_{k}']}" for k in range(len(more)))
    return rows.mapInArrow(run, schema).withColumnsRenamed({f"more_{k}": c for k, c in enumerate(more)})
