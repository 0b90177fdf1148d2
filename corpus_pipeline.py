"""From raw documents to packed training windows: quality, toxicity, exact and near duplicates, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkkit.llm import exact, near, packing, quality, toxicity
from sparkkit.llm.common import fold
from sparkkit.session import new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and that the weakly supervised rules hold to be good."""
    return quality.assess(docs, COLUMNS).filter("kept").select(*COLUMNS)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half; the lexicon is learned from labelled documents of this stage."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id") != 0)
    lexicon = toxicity.fit(toxicity.sample_labelled(docs, labels))
    return toxicity.score(docs, lexicon, more=COLUMNS[1:]).filter("predicted = 0").select(*COLUMNS)


def exact_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact.dedup(docs, COLUMNS)


def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (five-word shingles, similarity 0.8 or more), the document with the smallest id."""
    return near.dedup(docs, COLUMNS, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of windows of 2048 tokens over what is left: one row per piece."""
    return packing.piece_rows(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, size=2048))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality), ("toxicity", not_toxic), ("exact_dedup", exact_once), ("near_dedup", near_once), ("packing", packed),
]

#: SQL can express neither the learned stages nor the packing; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and read again as the next one's documents.

    Null and empty texts fail the first stage. An empty table gives no windows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
