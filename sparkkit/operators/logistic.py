"""Logistic regression on sparse document vectors, and its evaluation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkkit.functions.scalars import log1p_exp, ratio, sigmoid
from sparkkit.operators.packed import added, flat, row_sums, sliced, stored_packed
from sparkkit.operators.regression import BoldDriver
from sparkkit.operators.vocabulary import by_position

#: Numbers of a gradient that one task adds up.
PART = 1 << 12


@dataclass
class LogisticModel:
    coefficients: np.ndarray
    trace: list[tuple] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        """``pos, coefficient``, one row per dictionary position."""
        rows = [(i, float(c)) for i, c in enumerate(self.coefficients)]
        return spark.createDataFrame(rows, "pos int, coefficient double")

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.trace, "round int, loss double, rate double, step double")


def sparse_rows(rows: DataFrame, label: str, doc: str = "doc_id", value: str = "val") -> DataFrame:
    """``doc, label, idx, val``: the documents of ``vocabulary.tfidf_rows`` that hold a dictionary word."""
    return rows.where(F.size("idx") > 0).select(doc, F.col(label).cast("double").alias("label"), "idx", F.col(value).alias("val"))


def _gradient_step(size: int, shared):
    """Partial loss and gradient of one task's rows, in parts of ``PART`` numbers; the loss stands first."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        sums = np.zeros(1 + size)
        for batch in batches:
            if not len(batch):
                continue
            lengths, idx = flat(batch.column("idx"), np.int32)
            val = flat(batch.column("val"), np.float64)[1]
            label = batch.column("label").to_numpy(zero_copy_only=False)
            at = idx.astype(np.int64)
            z = row_sums(val * weights[at], lengths)
            small = np.exp(-np.abs(z))
            chance = np.where(z >= 0, 1.0, small) / (1.0 + small)
            sums[0] += np.sum(np.maximum(z, 0.0) + np.log1p(small) - label * z)
            sums[1:] += np.bincount(at, weights=val * np.repeat(chance - label, lengths), minlength=size)
        yield sliced(sums, PART)

    return partial


def fit(
    rows: DataFrame,
    size: int,
    start: float = 0.01,
    rate: float = 0.1,
    rounds: int = 400,
    tolerance: float = 1e-4,
    l2: float = 0.0,
) -> LogisticModel:
    """Batch gradient descent without intercept over ``sparse_rows`` output.

    Each round is one pass that sums loss and gradient together; only ``size`` numbers
    come back. The norm of the weights is added to the loss that steers the rate;
    ``l2`` adds a true penalty to the gradient. Stops when a step, from the second
    round on, is shorter than ``tolerance``.
    """
    spark = rows.sparkSession
    rows = rows.select("label", F.col("idx").cast("array<int>").alias("idx"), F.col("val").cast("array<double>").alias("val"))
    rows = stored_packed(rows, "training-rows", idx=np.int32, val=np.float64).persist()
    weights = np.full(size, start)
    driver = BoldDriver(rate, shrink_on_tie=True)
    trace = []
    try:
        for number in range(1, rounds + 1):
            shared = spark.sparkContext.broadcast(weights)
            parts = rows.mapInArrow(_gradient_step(size, shared), "part bigint, numbers array<double>")
            found = added(parts, 1 + size, PART)
            shared.destroy()
            gradient, loss = found[1:], float(found[0]) + float(np.sqrt(np.sum(weights**2)))
            step = driver.rate * (gradient + l2 * weights)
            weights = weights - step
            driver.observe(loss)
            length = float(np.linalg.norm(step))
            trace.append((number, loss, float(driver.rate), length))
            if number > 1 and length < tolerance:
                break
    finally:
        rows.unpersist()
    return LogisticModel(weights, trace)


def _dot(weights: np.ndarray):
    """z of every row: the sum over its positions of value times weight, 0 beyond the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx = batch.column("idx")
            lengths, at = idx.value_lengths().to_numpy(), idx.flatten().to_numpy()
            known = at < len(weights)
            weight = np.where(known, weights[np.where(known, at, 0)] if len(weights) else 0.0, 0.0)
            row = np.repeat(np.arange(len(batch)), lengths)
            z = np.bincount(row, weights=batch.column("val").flatten().to_numpy() * weight, minlength=len(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("label"), pa.array(z)], ["doc", "label", "z"])

    return run


def linear_scores(rows: DataFrame, coefficients: DataFrame, label: str, doc: str = "doc_id") -> DataFrame:
    """``doc, label, z`` of every row of ``vocabulary.tfidf_rows``; documents without a dictionary word have z = 0.

    The coefficients have at most one row per dictionary word and are sent to all tasks.
    """
    kinds = dict(rows.dtypes)
    named = rows.select(F.col(doc).alias("doc"), F.col(label).alias("label"), "idx", "val")
    scored = named.mapInArrow(_dot(by_position(coefficients, "coefficient")), f"doc {kinds[doc]}, label {kinds[label]}, z double")
    return scored.withColumnsRenamed({"doc": doc, "label": label})


def log_loss(scores: DataFrame, label: str, z: str = "z") -> DataFrame:
    """One row ``loss``: the sum over documents of ln(1 + e^z) − label·z."""
    return scores.agg(F.sum(log1p_exp(z) - F.col(label) * F.col(z)).alias("loss"))


def predict(scores: DataFrame, threshold: float = 0.5, z: str = "z") -> DataFrame:
    """Adds ``chance`` and ``predicted`` (1 from the threshold on)."""
    return scores.withColumn("chance", sigmoid(z)).withColumn(
        "predicted", F.when(F.col("chance") >= threshold, 1).otherwise(0)
    )


def confusion(predictions: DataFrame, label: str, predicted: str = "predicted") -> DataFrame:
    """One row ``tp, tn, fp, fn``."""
    actual, guess = F.col(label) == 1, F.col(predicted) == 1
    return predictions.agg(
        F.count_if(actual & guess).alias("tp"),
        F.count_if(~actual & ~guess).alias("tn"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(actual & ~guess).alias("fn"),
    )


def f1(counts: DataFrame) -> DataFrame:
    """Adds ``precision, recall, f1``; null where a denominator is 0."""
    scored = counts.withColumn("precision", ratio("tp", F.expr("tp + fp")))
    scored = scored.withColumn("recall", ratio("tp", F.expr("tp + fn")))
    return scored.withColumn("f1", ratio(F.expr("2 * precision * recall"), F.expr("precision + recall")))


def false_positives(predictions: DataFrame, pages: DataFrame, label: str, doc: str = "doc_id") -> DataFrame:
    """``doc, url`` of documents wrongly given class 1."""
    wrong = predictions.where((F.col(label) == 0) & (F.col("predicted") == 1)).select(doc)
    return pages.join(wrong, doc)
