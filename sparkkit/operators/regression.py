"""Linear regression from one pass of sums.

Cost and gradient of squared error need the data only through the Gram matrix of
(1, x1 … xp, y). One aggregate computes it; the gradient rounds then cost nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkkit.functions.scalars import col


def fit_line(df: DataFrame, x: str | Column, y: str | Column) -> DataFrame:
    """One row ``n, slope, intercept`` of the least-squares line."""
    pairs = df.select(col(x).cast("double").alias("x"), col(y).cast("double").alias("y")).dropna()
    sums = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("x").alias("sx"),
        F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
    )
    return line_from_sums(sums)


def line_from_sums(sums: DataFrame) -> DataFrame:
    """Slope and intercept from the columns ``n, sx, sy, sxy, sxx``."""
    slope = F.try_divide(F.expr("n * sxy - sx * sy"), F.expr("n * sxx - sx * sx"))
    fitted = sums.withColumn("slope", slope)
    return fitted.select("n", "slope", F.expr("(sy - slope * sx) / n").alias("intercept"))


def gram(df: DataFrame, features: Sequence[str | Column], target: str | Column) -> np.ndarray:
    """Sums of products of (1, features…, target) over the complete rows."""
    names = [f"v{i}" for i in range(len(features) + 1)]
    rows = df.select(
        *(col(c).cast("double").alias(name) for c, name in zip([*features, target], names, strict=True))
    ).dropna()
    terms = [F.lit(1.0), *(F.col(name) for name in names)]
    size = len(terms)
    cells = [(i, j) for i in range(size) for j in range(i, size)]
    sums = rows.agg(*(F.sum(terms[i] * terms[j]).alias(f"s{i}_{j}") for i, j in cells)).first()
    if sums[0] is None:
        raise ValueError("no complete rows")
    matrix = np.zeros((size, size))
    for (i, j), value in zip(cells, sums, strict=True):
        matrix[i, j] = matrix[j, i] = value
    return matrix


def squared_error(matrix: np.ndarray, weights: np.ndarray) -> float:
    """Sum of squared errors of ``weights`` (intercept first), from the Gram matrix."""
    residual = np.append(-weights, 1.0)
    return float(residual @ matrix @ residual)


def sum_of_squares(df: DataFrame, target: str | Column, predicted: str | Column) -> DataFrame:
    """One row ``sse`` for predictions held in a column."""
    return df.agg(F.sum(F.pow(col(target) - col(predicted), 2)).alias("sse"))


@dataclass
class BoldDriver:
    """Learning rate that grows after a fall in cost and shrinks after a rise.

    ``shrink_on_tie`` treats an unchanged cost as a rise.
    """

    rate: float
    shrink_on_tie: bool = False
    grow: float = 1.05
    shrink: float = 0.5
    last: float | None = None

    def observe(self, cost: float) -> float:
        if self.last is not None:
            if cost < self.last:
                self.rate *= self.grow
            elif cost > self.last or self.shrink_on_tie:
                self.rate *= self.shrink
        self.last = cost
        return self.rate


@dataclass
class Descent:
    """Result of a gradient descent: weights (intercept first) and the trace of rounds."""

    weights: np.ndarray
    rate: float
    trace: list[tuple] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        """``round, cost, rate, weights``, one row per round."""
        return spark.createDataFrame(self.trace, "round int, cost double, rate double, weights array<double>")


def descend(matrix: np.ndarray, start: float | Sequence[float] = 0.1, rate: float = 1e-4, rounds: int = 100) -> Descent:
    """Gradient descent on squared error over the Gram matrix.

    Each round reports the cost of the weights it started from, then updates all
    weights at once and lets the driver set the next rate.
    """
    sums = [[float(x) for x in row] for row in matrix]
    n, size = sums[0][0], len(sums) - 1
    weights = [float(w) for w in np.broadcast_to(np.asarray(start, dtype=float), (size,))]
    driver = BoldDriver(rate)
    trace = []
    for number in range(1, rounds + 1):
        # plain loops: the order of the operations is fixed, so equal sums give an equal trace anywhere
        pulls = []
        for row in sums:
            pull = row[size]
            for w, x in zip(weights, row):
                pull -= w * x
            pulls.append(pull)
        cost = pulls.pop()
        for w, pull in zip(weights, pulls):
            cost -= w * pull
        weights = [w + driver.rate * 2.0 / n * pull for w, pull in zip(weights, pulls)]
        driver.observe(cost)
        trace.append((number, cost, float(driver.rate), list(weights)))
    return Descent(np.array(weights), driver.rate, trace)
