"""The three tokenisers: as one row per word, and as the words of each text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.functions.scalars import col

# Fixed values.
WORD_EDGE = ".,<>()-[]:;?!"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WHITESPACE = "(?U)[\\s\\x1c-\\x1f]+"
LETTER_THEN_WORD = "(?U)[A-Za-z]\\w+"




@dataclass(frozen=True)
class Tokeniser:
    """``rows(docs, text)`` gives ``word`` rows next to the other columns; calling the tokeniser does the same.
    ``words(text)`` is a column with the same words of a text as an array. Where a task can find them faster in a whole
    Arrow column, ``split`` does so; its lists may hold empty strings besides the words."""

    rows: Callable[[DataFrame, str], DataFrame]
    words: Callable[[str | Column], Column]
    split: Callable[[pa.Array], pa.ListArray] | None = None

    def __call__(self, docs: DataFrame, text: str = "text") -> DataFrame:
        return self.rows(docs, text)


def _explode(docs: DataFrame, text: str, words: Column) -> DataFrame:
    kept = [name for name in docs.columns if name != text]
    return docs.select(*kept, F.explode(words).alias("word"))


def letter_words(text: str | Column) -> Column:
    """Runs of ASCII letters, in lower case."""
    return F.transform(F.array_remove(F.split(col(text), "[^a-zA-Z]+"), ""), F.lower)


def _letter_rows(docs: DataFrame, text: str) -> DataFrame:
    words = _explode(docs, text, F.split(col(text), "[^a-zA-Z]+")).where("word <> ''")
    return words.withColumn("word", F.lower("word"))


def split_letters(texts: pa.Array) -> pa.ListArray:
    """``letter_words`` of every text of an Arrow column, byte by byte: no byte of a longer UTF-8 sequence is a letter."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    used = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    table = np.full(256, ord(" "), np.uint8)
    for first in (ord("A"), ord("a")):
        table[first : first + 26] = np.arange(ord("a"), ord("z") + 1)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(table[used]))
    return pc.ascii_split_whitespace(plain)


def trimmed_words(text: str | Column) -> Column:
    """Words between whitespace, in lower case, edges trimmed, longer than one character."""
    words = F.transform(F.split(F.lower(col(text)), WHITESPACE), lambda w: F.btrim(w, F.lit(WORD_EDGE)))
    return F.filter(words, lambda w: F.length(w) > 1)


def _trimmed_rows(docs: DataFrame, text: str) -> DataFrame:
    words = _explode(docs, text, F.split(F.lower(col(text)), WHITESPACE))
    return words.withColumn("word", F.btrim("word", F.lit(WORD_EDGE))).where(F.length("word") > 1)


def strict_words(text: str | Column) -> Column:
    """Words between single spaces that hold a letter followed by a word character, in lower case,
    punctuation trimmed, longer than two characters."""
    words = F.filter(F.split(col(text), " "), lambda w: w.rlike(LETTER_THEN_WORD))
    return F.filter(F.transform(words, lambda w: F.btrim(F.lower(w), F.lit(PUNCTUATION))), lambda w: F.length(w) > 2)


def _strict_rows(docs: DataFrame, text: str) -> DataFrame:
    words = _explode(docs, text, F.split(col(text), " "))
    words = words.where(F.col("word").rlike(LETTER_THEN_WORD))
    return words.withColumn("word", F.btrim(F.lower("word"), F.lit(PUNCTUATION))).where(F.length("word") > 2)


explode_letters = Tokeniser(_letter_rows, letter_words, split_letters)
explode_trimmed = Tokeniser(_trimmed_rows, trimmed_words)
explode_strict = Tokeniser(_strict_rows, strict_words)
