"""Newsgroup posts: sparse counts and mixture clusters, from tagged lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.functions.tokens import explode_strict, explode_trimmed
from sparkkit.operators import mixture, vocabulary
from sparkkit.sources.tagged import group_of, header_tag, tagged_span
from sparkkit.sources.tagged import doc_id as id_of


def posts(lines: DataFrame, column: str = "value") -> DataFrame:
    """``doc_id, header, category, text`` of tagged lines."""
    return lines.select(
        id_of(column).alias("doc_id"),
        header_tag(column).alias("header"),
        group_of(id_of(column)).alias("category"),
        tagged_span(column).alias("text"),
    ).where("doc_id is not null")


def post_dictionary(docs: DataFrame, size: int = vocabulary.DICTIONARY_SIZE) -> DataFrame:
    return vocabulary.dictionary(docs, "text", size, explode_trimmed)


def post_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``vocabulary.term_rows`` of posts; the stricter tokeniser decides which words of a post count."""
    return vocabulary.term_rows(docs, words, tokeniser=explode_strict)


def post_map(docs: DataFrame, words: DataFrame, doc_id: str, below: int = 100) -> DataFrame:
    """Count map of one post, positions under ``below``."""
    post = docs.where(F.col("doc_id") == doc_id)
    return vocabulary.count_map(post_counts(post, words), below=below)


def cluster(
    docs: DataFrame,
    words: DataFrame,
    clusters: int = 20,
    rounds: int = 200,
    alpha: float = 0.1,
    beta: float = 0.1,
    seed: int = 0,
    size: int | None = None,
) -> tuple[mixture.MixtureState, DataFrame]:
    """Mixture weights and the cluster of every post, also of posts without a dictionary word.

    ``size`` is the number of words with a weight, by default all of ``words``.
    """
    rows = mixture.document_rows(post_counts(docs, words))
    return mixture.gibbs(rows, clusters, words.count() if size is None else size, rounds, alpha, beta, seed)


def cluster_words(state: mixture.MixtureState, words: DataFrame, k: int = 50) -> DataFrame:
    return mixture.top_words(state, words, k)


def cluster_categories(assigned: DataFrame, docs: DataFrame, k: int = 3) -> DataFrame:
    """Commonest true categories per cluster, joined by document."""
    return mixture.top_categories(assigned.join(docs.select("doc_id", "category"), "doc_id"), "category", k)
