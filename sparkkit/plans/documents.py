"""Document collections: category votes and two-class text classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.operators import logistic, neighbors, vocabulary
from sparkkit.session import materialize

# Fixed values.
COURT_PREFIX = "AU"
COURT_WORDS = ("applicant", "and", "attack", "protein", "court")


def with_class(docs: DataFrame, doc: str = "doc_id", label: str = "label") -> DataFrame:
    """1 for court cases, known by the start of their id."""
    return docs.withColumn(label, F.when(F.startswith(F.col(doc), F.lit(COURT_PREFIX)), 1).otherwise(0))


def both_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """One corpus with the column ``split``."""
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def vote(
    docs: DataFrame,
    links: DataFrame,
    query: str,
    k: int = 10,
    metric: str = "dot",
    size: int = vocabulary.DICTIONARY_SIZE,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Categories of the documents nearest to the query text."""
    words = materialize(vocabulary.dictionary(docs, text, size), "dictionary")
    frequency = vocabulary.document_frequency(docs, words, text)
    idf = materialize(vocabulary.inverse_frequency(frequency, docs.count()), "idf")
    counts = vocabulary.term_counts(docs, words, doc, text)
    vectors = vocabulary.weigh(vocabulary.term_frequency(counts, doc), idf)
    scores = neighbors.score(vectors, neighbors.query_weights(query, words, idf), doc, metric)
    return neighbors.category_vote(scores, links, k, doc)


def vote_all(
    docs: DataFrame,
    links: DataFrame,
    queries: DataFrame,
    k: int = 10,
    metric: str = "dot",
    size: int = vocabulary.DICTIONARY_SIZE,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``query, category, num``: the vote for every row of ``queries`` (``query, text``) that holds a dictionary word."""
    words = materialize(vocabulary.dictionary(docs, text, size), "dictionary")
    rows = materialize(vocabulary.term_rows(docs, words, doc, text), "term-rows")
    idf = materialize(vocabulary.inverse_frequency(vocabulary.frequency_from_rows(rows), rows.count()), "idf")
    asked = vocabulary.weigh(vocabulary.term_frequency(vocabulary.counted_terms(queries, words, "query")), idf)
    weights = materialize(asked.select("query", "pos", F.col("tfidf").alias("weight")), "weights")
    found = neighbors.nearest(vocabulary.weigh_rows(rows, idf), weights, k, doc, metric)
    return neighbors.category_votes(found, links, k, doc)


def court_averages(docs: DataFrame, words: DataFrame) -> DataFrame:
    """Average term frequency of five words in court cases and in all other documents."""
    return vocabulary.average_frequency(with_class(docs), words, COURT_WORDS, "label")


def strongest_words(model: logistic.LogisticModel, words: DataFrame, k: int = 5) -> DataFrame:
    """``word, coefficient`` of the largest coefficients."""
    ranked = model.frame(words.sparkSession).orderBy(F.desc("coefficient"), "pos").limit(k)
    return words.select("word", "pos").join(F.broadcast(ranked), "pos").orderBy(F.desc("coefficient"), "pos").select(
        "word", "coefficient"
    )


def classify(
    train: DataFrame,
    test: DataFrame,
    size: int = vocabulary.DICTIONARY_SIZE,
    threshold: float = 0.5,
    label: str = "label",
    doc: str = "doc_id",
    text: str = "text",
    **fit_options: float,
) -> tuple[logistic.LogisticModel, DataFrame]:
    """Fit on the training split, predict every document of the test split; the dictionary covers both."""
    columns = [doc, text, label]
    corpus = both_splits(train.select(*columns), test.select(*columns))
    words = materialize(vocabulary.dictionary(corpus, text, size), "dictionary")
    rows = vocabulary.tfidf_rows(corpus, words, corpus.count(), doc, text, keep=[label, "split"])
    rows = materialize(rows, "vectors")
    model = logistic.fit(logistic.sparse_rows(rows.where("split = 'train'"), label, doc), size, **fit_options)
    scores = logistic.linear_scores(rows.where("split = 'test'"), model.frame(train.sparkSession), label, doc)
    return model, logistic.predict(scores, threshold)
