"""Dictionary, term frequency, document frequency and TF-IDF.

The terms of a document are one row: the dictionary positions it holds, ascending, and their counts. They are
counted in the task that reads the text, so neither the order of rows nor the plan of a join matters, and no text
is shuffled. The long form has a row per position; positions with no occurrence have none, which leaves every sum
and dot product unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkkit.functions.scalars import ratio
from sparkkit.functions.tokens import Tokeniser, explode_letters
from sparkkit.operators.grouping import count_by
from sparkkit.operators.ranking import positions, top_k
from sparkkit.session import bounded_batches, materialize

DICTIONARY_SIZE = 20_000
#: Words of a dictionary that may be sent to all tasks.
LARGEST_DICTIONARY = 1_000_000


def _count_words(split):
    """Words of each batch of texts and how often they occur in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(split(batch.column("text")).flatten())
            words = found.field("values")
            yield pa.RecordBatch.from_arrays([words, found.field("counts")], ["word", "cnt"]).filter(pc.not_equal(words, ""))

    return run


def word_count(docs: DataFrame, text: str = "text", tokeniser: Tokeniser = explode_letters) -> DataFrame:
    """``word, cnt``; what a task counts itself is added up, so a frequent word is one row per batch or task."""
    if not tokeniser.split:
        return count_by(tokeniser(docs.select(text), text), ["word"], "cnt")
    texts = bounded_batches(docs).select(F.col(text).alias("text"))
    counted = texts.mapInArrow(_count_words(tokeniser.split), "word string, cnt bigint")
    return counted.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def dictionary(
    docs: DataFrame, text: str = "text", size: int = DICTIONARY_SIZE, tokeniser: Tokeniser = explode_letters
) -> DataFrame:
    """``word, cnt, pos`` of the ``size`` most frequent words; ties at the cut go by word.

    The result has at most ``size`` rows, which is the bound behind every broadcast of it.
    """
    return positions(top_k(word_count(docs, text, tokeniser), size, "cnt", ["word"]), "cnt", ["word"])


def _listed(words: DataFrame, *columns: str) -> pa.Table:
    """The named columns of a frame with one row per dictionary word, on the driver; too large a dictionary is an error."""
    found = words.select(*columns).limit(LARGEST_DICTIONARY + 1).toArrow()
    if found.num_rows > LARGEST_DICTIONARY:
        raise ValueError(f"a dictionary has at most {LARGEST_DICTIONARY} words")
    return found.combine_chunks()


def by_position(frame: DataFrame, value: str) -> np.ndarray:
    """The column ``value`` of a frame with one row per dictionary position, as an array by position; 0 where there is no row."""
    found = _listed(frame, "pos", value)
    pos = found.column("pos").to_numpy()
    out = np.zeros(int(pos.max(initial=-1)) + 1)
    out[pos] = found.column(value).to_numpy()
    return out


def _count_in_rows(words: pa.Table, split):
    """Looks up the words of each text and counts equal positions within it."""
    known, place = words.column("word").combine_chunks(), words.column("pos").to_numpy().astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = split(batch.column("words")) if split else batch.column("words")
            starts = np.concatenate([[0], np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy())])
            at = pc.index_in(lists.flatten(), value_set=known.cast(pa.string()))
            held = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            row = np.searchsorted(starts, held, "right") - 1
            key, cnt = np.unique(row << 32 | place[at.to_numpy(zero_copy_only=False)[held].astype(np.int64)], return_counts=True)
            ends = pa.array(np.searchsorted(key, np.arange(len(batch) + 1) << 32), pa.int32())
            total = np.bincount(row, minlength=len(batch)).astype(np.int64)
            idx = pa.ListArray.from_arrays(ends, pa.array((key & 0xFFFFFFFF).astype(np.int32)))
            counts = pa.ListArray.from_arrays(ends, pa.array(cnt.astype(np.int64)))
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "words"]
            names = [name for name in batch.schema.names if name != "words"]
            yield pa.RecordBatch.from_arrays([*kept, idx, counts, pa.array(total)], [*names, "idx", "cnt", "total"])

    return run


def term_rows(
    docs: DataFrame,
    words: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    tokeniser: Tokeniser = explode_letters,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``doc, *keep, idx, cnt, total``: one row per row of ``docs`` with the dictionary positions in its text, ascending, their
    counts, and the sum of these. A null text, and one without dictionary words, has empty arrays.

    ``words`` (``word, pos``) is sent to all tasks; its size is checked.
    """
    named = {f"keep_{i}": name for i, name in enumerate((doc, *keep))}
    found = F.col(text) if tokeniser.split else tokeniser.words(text)
    rows = bounded_batches(docs).select(*(F.col(n).alias(k) for k, n in named.items()), found.alias("words"))
    schema = ", ".join(f"{k} {kind}" for k, kind in rows.dtypes if k != "words") + ", idx array<int>, cnt array<bigint>, total bigint"
    return rows.mapInArrow(_count_in_rows(_listed(words, "word", "pos"), tokeniser.split), schema).withColumnsRenamed(named)


def long_form(rows: DataFrame) -> DataFrame:
    """``term_rows`` with a row ``pos, cnt`` per position, next to the other columns."""
    kept = [name for name in rows.columns if name not in ("idx", "cnt")]
    return rows.select(*kept, F.inline(F.arrays_zip(F.col("idx").alias("pos"), "cnt")).alias("pos", "cnt"))


def counted_terms(
    docs: DataFrame,
    words: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    tokeniser: Tokeniser = explode_letters,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``doc, *keep, pos, cnt, total`` of the dictionary words of each row; ``total`` sums up the row's ``cnt``."""
    return long_form(term_rows(docs, words, doc, text, tokeniser, keep)).select(doc, *keep, "pos", "cnt", "total")


def term_counts(
    docs: DataFrame,
    words: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    tokeniser: Tokeniser = explode_letters,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``doc, *keep, pos, cnt`` of the dictionary words of each document (one row of ``docs``)."""
    return counted_terms(docs, words, doc, text, tokeniser, keep).drop("total")


def term_frequency(counts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Adds ``tf``, the count relative to all dictionary words of the document; ``total`` spares a shuffle if it is there."""
    if "total" in counts.columns:
        return counts.withColumn("tf", ratio("cnt", "total")).drop("total")
    total = F.sum("cnt").over(Window.partitionBy(doc))
    return counts.withColumn("tf", ratio("cnt", total))


def document_frequency(
    docs: DataFrame, words: DataFrame, text: str = "text", tokeniser: Tokeniser = explode_letters
) -> DataFrame:
    """``pos, df``: documents holding each dictionary word.

    Repeats are removed where the text is read, so only partial counts are shuffled.
    """
    one = docs.select(text).withColumn("nothing", F.lit(None).cast("int"))
    return frequency_from_rows(term_rows(one, words, "nothing", text, tokeniser))


def frequency_from_rows(rows: DataFrame) -> DataFrame:
    """``pos, df`` from ``term_rows``."""
    return count_by(rows.select(F.explode("idx").alias("pos")), ["pos"], "df")


def frequency_from_counts(counts: DataFrame) -> DataFrame:
    """``pos, df`` from term counts."""
    return count_by(counts, ["pos"], "df")


def inverse_frequency(frequency: DataFrame, documents: int) -> DataFrame:
    """``pos, idf`` with idf = ln(documents / df)."""
    return frequency.select("pos", F.ln(ratio(F.lit(documents), "df")).alias("idf"))


def weigh(frequencies: DataFrame, idf: DataFrame) -> DataFrame:
    """Adds ``tfidf``; ``idf`` has at most one row per dictionary word."""
    joined = frequencies.join(F.broadcast(idf), "pos")
    return joined.withColumn("tfidf", F.col("tf") * F.col("idf"))


def tfidf(
    docs: DataFrame,
    words: DataFrame,
    documents: int,
    doc: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
    tokeniser: Tokeniser = explode_letters,
) -> DataFrame:
    """``doc, *keep, pos, cnt, tf, idf, tfidf`` of every document with a dictionary word.

    Texts are read once: the term rows are stored, and both the document frequencies and the result come from them.
    """
    rows = materialize(term_rows(docs, words, doc, text, tokeniser, keep), "term-rows")
    frequencies = term_frequency(long_form(rows), doc).select(doc, *keep, "pos", "cnt", "tf")
    return weigh(frequencies, inverse_frequency(frequency_from_rows(rows), documents))


def _weigh_rows(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, cnt = batch.column("idx"), batch.column("cnt")
            total = np.repeat(batch.column("total").to_numpy(), idx.value_lengths().to_numpy())
            val = cnt.flatten().to_numpy() / total * idf[idx.flatten().to_numpy()]
            ends = np.concatenate([[0], np.cumsum(idx.value_lengths().to_numpy())])
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name not in ("cnt", "total")]
            names = [name for name in batch.schema.names if name not in ("cnt", "total")]
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(val))], [*names, "val"])

    return run


def weigh_rows(rows: DataFrame, idf: DataFrame) -> DataFrame:
    """``term_rows`` with the TF-IDF of every position (``val``) in the place of ``cnt`` and ``total``."""
    kept = [name for name in rows.columns if name not in ("cnt", "total", "idx")]
    schema = ", ".join(f"`{k}` {kind}" for k, kind in rows.dtypes if k in kept) + ", idx array<int>, val array<double>"
    return rows.select(*kept, "idx", "cnt", "total").mapInArrow(_weigh_rows(by_position(idf, "idf")), schema)


def tfidf_rows(
    docs: DataFrame,
    words: DataFrame,
    documents: int,
    doc: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
    tokeniser: Tokeniser = explode_letters,
) -> DataFrame:
    """``doc, *keep, idx, val``: the TF-IDF of each row of ``docs`` as one row, also of those without a dictionary word."""
    rows = materialize(term_rows(docs, words, doc, text, tokeniser, keep), "term-rows")
    return weigh_rows(rows, inverse_frequency(frequency_from_rows(rows), documents))


def average_frequency(
    docs: DataFrame,
    words: DataFrame,
    chosen: Sequence[str],
    label: str,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``label, word, avg_tf`` over the documents of a class that hold any dictionary word;
    0 where a class lacks the word.

    A document's frequencies are read off its own row; only sums per class and task are shuffled.
    """
    place = {row.word: row.pos for row in words.where(F.col("word").isin(*chosen)).select("word", "pos").collect()}
    rows = term_rows(docs, words, doc, text, keep=[label]).where("total > 0")

    def own(word: str):
        at = F.array_position("idx", F.lit(place[word]).cast("int")).cast("int")
        return F.when(at > 0, ratio(F.get("cnt", at - 1), "total"))

    sums = [F.coalesce(F.sum(own(w)) if w in place else F.lit(None), F.lit(0.0)).alias(f"tf_{i}") for i, w in enumerate(chosen)]
    per_class = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n_docs"), *sums)
    entries = F.array(*(F.struct(F.lit(w).alias("word"), F.col(f"tf_{i}").alias("tf")) for i, w in enumerate(chosen)))
    listed = per_class.select(label, "n_docs", F.explode(entries).alias("e"))
    return listed.select(label, F.col("e.word").alias("word"), ratio("e.tf", "n_docs").alias("avg_tf"))


def count_map(rows: DataFrame, doc: str = "doc_id", below: int | None = None) -> DataFrame:
    """``doc, counts``: the counts of each of ``term_rows`` as a map from position to count, if ``below`` is given of the
    positions under it. Documents without a dictionary word have an empty map."""
    maps = rows.select(doc, F.map_from_arrays("idx", "cnt").alias("counts"))
    return maps if below is None else maps.withColumn("counts", F.map_filter("counts", lambda pos, cnt: pos < below))
