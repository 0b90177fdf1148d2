"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import slices, split_words, texts_of
from sparkkit.operators.ranking import top_k_per_group
from sparkkit.session import materialize

LONGEST = 5
#: New words scored at once.
AT_ONCE = 20_000
#: Letters in the sense of Unicode's general category, as in fitting: numbers such as ½, ² or ① are none.
_LETTERS = regex.compile(r"\p{L}+")


@dataclass
class Model:
    """Per language (row of each array): log frequencies of words and, by length, of n-grams."""

    languages: list[str]
    words: dict[str, tuple[float, ...]]
    grams: list[dict[str, tuple[float, ...]]]  # [0]: length 1
    floor: tuple[float, ...]


def fit(docs: DataFrame, docs_per_language: int = 1500, words_per_language: int = 20_000, grams_per_language: int = 5_000) -> Model:
    """Learns from rows with a text and a language.

    Of each language the counts come from a sample of about ``docs_per_language`` rows, chosen by a hash of doc_id, so that a rare
    language is learned as well as a common one at every size of the table. The model holds each language's
    ``words_per_language`` most frequent words and, of each length up to five, its ``grams_per_language`` most frequent n-grams of words
    between bars, so it is small enough to be sent to all tasks. Ties go to the smaller string. The number of
    languages is taken to be that of a table of languages. The sample's word counts are stored once.
    """
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", F.col("lang").alias("language"))
    sizes = {r.language: r["count"] for r in rows.groupBy("language").count().collect()}
    if not sizes:
        return Model([], {}, [{} for _ in range(LONGEST)], ())
    shares = [F.lit(x) for language, n in sizes.items() for x in (language, int(min(1.0, docs_per_language / n) * (1 << 30)) + 1)]
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30))
    words = (
        rows.filter(drawn < F.element_at(F.create_map(*shares), F.col("language")))
        .select("language", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("gram"))
        .groupBy("language", "gram").agg(F.count(F.lit(1)).alias("n"))
    )
    words = materialize(words, "language-words")
    tables = [_most(words, words_per_language)]
    marked = words.select("language", "n", F.concat(F.lit("|"), "gram", F.lit("|")).alias("marked"))
    for size in range(1, LONGEST + 1):
        starts = f"sequence(1, length(marked) - {size - 1})"
        grams = marked.filter(f"length(marked) >= {size}").select(
            "language", "n", F.expr(f"explode(transform({starts}, i -> substring(marked, i, {size})))").alias("gram")
        )
        tables.append(_most(grams.groupBy("language", "gram").agg(F.sum("n").alias("n")), grams_per_language))
    languages = sorted({language for table in tables for counts in table.values() for language in counts})
    logs = [_logs(table, languages) for table in tables]
    floor = tuple(math.log(1e-7) for _ in languages)
    return Model(languages, logs[0], logs[1:], floor)


def _most(counts: DataFrame, most: int) -> dict[str, dict[str, int]]:
    """Counts by language of the strings that are among the ``most`` most frequent of any language; for each language at
    most that many rows reach the driver."""
    chosen = top_k_per_group(counts, ["language"], most, "n", ["gram"]).select("gram").distinct()
    by: dict[str, dict[str, int]] = defaultdict(dict)
    for r in counts.join(chosen, "gram").select("gram", "language", "n").collect():
        by[r.gram][r.language] = r.n
    return dict(by)


def _logs(table: dict[str, dict[str, int]], languages: list[str]) -> dict[str, tuple[float, ...]]:
    """Log frequency per language, half a count added to each."""
    totals: dict[str, float] = defaultdict(float)
    for counts in table.values():
        for language, n in counts.items():
            totals[language] += n
    bottom = [math.log(totals[x] + 0.5 * (len(table) + 1)) for x in languages]
    return {gram: tuple(math.log(counts.get(x, 0) + 0.5) - b for x, b in zip(languages, bottom)) for gram, counts in table.items()}


def word_score(word: str, model: Model) -> tuple[float, ...]:
    """A known word's log frequencies; else the mean, over its positions, of the longest known n-gram that begins there."""
    if (known := model.words.get(word)) is not None:
        return known
    marked = f"|{word}|"
    total = [0.0] * len(model.languages)
    for at in range(len(marked)):
        for size in range(min(LONGEST, len(marked) - at), 0, -1):
            if (found := model.grams[size - 1].get(marked[at : at + size])) is not None:
                break
        else:
            found = model.floor
        for k, x in enumerate(found):
            total[k] += x
    return tuple(x / len(marked) for x in total)


class Longest(dict):
    """For a stretch of a marked word the number of the longest known n-gram that begins it, or else of the floor: a row of ``logs``.

    Each stretch is looked for once; at most ``most`` are kept.
    """

    def __init__(self, model: Model, most: int = 100_000):
        super().__init__()
        known = [gram for grams in model.grams for gram in grams]
        self.number, self.most = {gram: k for k, gram in enumerate(known)}, most
        self.logs = np.array([x for grams in model.grams for x in grams.values()] + [model.floor]).reshape(-1 if model.languages else len(known) + 1, len(model.languages))

    def __missing__(self, stretch: str) -> int:
        if len(self) >= self.most:
            self.clear()
        found = (self.number.get(stretch[:size]) for size in range(len(stretch), 0, -1))
        self[stretch] = number = next((k for k in found if k is not None), len(self.number))
        return number


def word_scores(words: list[str], model: Model, longest: Longest) -> np.ndarray:
    """``word_score`` of each word."""
    scores = np.zeros((len(words), len(model.languages)))
    new = []
    for k, word in enumerate(words):
        if (known := model.words.get(word)) is not None:
            scores[k] = known
        else:
            new.append(k)
    if new:
        lengths = np.array([len(words[k]) + 2 for k in new])
        marked = [f"|{words[k]}|" for k in new]
        places = [longest[word[at : at + LONGEST]] for word in marked for at in range(len(word))]
        scores[new] = np.add.reduceat(longest.logs[places], np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
    return scores


class Scorer:
    """Scores of distinct words, each worked out once per worker; new words that would take it beyond ``most`` drop the older half first."""

    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most, self.longest = model, most, Longest(model)
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages) + 1))

    def sums(self, texts: pa.Array) -> np.ndarray:
        """Per text: summed scores of the languages, and in the last column the words with letters."""
        codes, words, offsets = split_words(texts)
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > self.most:
            n = len(self.place) // 2 if len(self.place) // 2 + len(words) <= self.most else len(self.place)
            self.place, self.rows = {w: k for k, w in enumerate(list(self.place)[n:])}, self.rows[n:]
            new = [w for w in words if w not in self.place]
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.rows = np.concatenate([self.rows, *(self._rows(new[k : k + AT_ONCE]) for k in range(0, len(new), AT_ONCE))])
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        sums = np.zeros((len(offsets) - 1, self.rows.shape[1]))
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            sums[filled] = np.add.reduceat(self.rows[at[codes]], offsets[filled], axis=0)
        return sums

    def _rows(self, words: list[str]) -> np.ndarray:
        lowered = [word.lower() for word in words]
        parts = [[lower] if lower.isascii() and lower.isalpha() else _LETTERS.findall(lower) for lower in lowered]
        rows = np.zeros((len(words), len(self.model.languages) + 1))
        rows[:, -1] = [len(of_word) for of_word in parts]
        scores = word_scores([part for of_word in parts for part in of_word], self.model, self.longest)
        np.add.at(rows[:, :-1], np.repeat(np.arange(len(words)), rows[:, -1].astype(np.int64)), scores)
        return rows


#: The scorer of the model that a Python worker has used last, by the name of the call.
_SCORERS: dict[str, Scorer] = {}


def _scorer(name: str, model: Model) -> Scorer:
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(model)
    return _SCORERS[name]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, ``lang_pred`` and ``score`` of every whole text.

    The prediction has the highest summed word score, the first in the alphabet among equals;
    ``score`` is its share under a softmax of the sums. ``und`` with score 0: the text is
    null, empty or without a letter, or nothing was learned. Repeated rows are judged each,
    an empty table stays empty, other columns are left out.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = _scorer(name, model)
        for block in slices(batches):
            sums = scorer.sums(block.column("text"))
            known = (sums[:, -1] > 0) & bool(model.languages)
            if model.languages:
                shifted = sums[:, :-1] - sums[:, :-1].max(axis=1, keepdims=True)
                best, share = shifted.argmax(axis=1), 1 / np.exp(shifted).sum(axis=1)
                names = [model.languages[b] if k else "und" for b, k in zip(best, known)]
            else:
                share, names = np.zeros(len(sums)), ["und"] * len(sums)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0))], ["doc_id", "lang_pred", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id bigint, lang_pred string, score double")
