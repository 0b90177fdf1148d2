import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkkit.operators import grouping, quantiles, ranking


@pytest.fixture(scope="module")
def sales(spark):
    data = [("a", "x", 1.0, 2), ("a", "y", 3.0, 2), ("b", "x", 5.0, 0), ("b", "x", 7.0, 0), ("c", "z", 2.0, 4)]
    return spark.createDataFrame(data, "k string, v string, num double, den int").repartition(3)


def test_keyed_aggregates(sales, rows):
    assert rows(grouping.count_by(sales, ["k"])) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(grouping.distinct_by(sales, ["k"], "v")) == [("a", 2), ("b", 1), ("c", 1)]
    assert rows(grouping.ratio_by(sales, ["k"], "num", "den")) == [("a", 1.0), ("b", None), ("c", 0.5)]
    assert rows(grouping.rate_by(sales, ["k"], F.col("v") == "x")) == [("a", 0.5), ("b", 1.0), ("c", 0.0)]
    assert rows(grouping.mean_by(sales, ["k"], "num")) == [("a", 2.0), ("b", 6.0), ("c", 2.0)]
    assert rows(grouping.max_by_key(sales, ["k"], "num")) == [("a", 3.0), ("b", 7.0), ("c", 2.0)]


def test_shares_sum_to_hundred(sales):
    row = grouping.share_of_rows(sales, {v: F.col("v") == v for v in "xyz"}).first()
    assert sum(row) == pytest.approx(100) and row.x == 60


def test_top_k_is_prefix_and_breaks_ties(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)] + [(99, None)], "id int, v int")
    previous = []
    for k in range(1, 12):
        got = [tuple(r) for r in ranking.top_k(df.repartition(k), k, "v", ["id"]).collect()]
        assert got[: k - 1] == previous and len(got) == k
        previous = got
    assert previous[:2] == [(2, 2), (5, 2)]


def test_top_k_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    top = ranking.top_k_per_group(df, ["g"], 3, "v", ["v"])
    assert sorted((r.g, r.v, r["rank"]) for r in top.collect())[:3] == [(0, 994, 3), (0, 996, 2), (0, 998, 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed, kind", [(0, "normal"), (1, "ties"), (2, "hot"), (3, "tiny"), (4, "wide")])
@pytest.mark.parametrize("buckets", [4, 4096])
def test_percentiles_match_numpy(spark, seed, kind, buckets):
    rng = np.random.default_rng(seed)
    values = {
        "normal": lambda: rng.normal(size=2000),
        "ties": lambda: rng.integers(0, 5, size=2000).astype(float),
        "hot": lambda: np.concatenate([np.full(1500, 2.5), rng.normal(size=700)]),
        "tiny": lambda: np.array([3.0]),
        "wide": lambda: np.exp(rng.normal(scale=8, size=800)),
    }[kind]()
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles.percentiles(df, "v", probabilities, buckets)
    assert got == pytest.approx(np.percentile(values, [100 * p for p in probabilities]), rel=1e-12)


def test_outliers_and_centre(spark, rows):
    values = [1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 40.0, -50.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    q1, q3 = np.percentile(values, [25, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert rows(quantiles.fence_outliers(df, "v")) == sorted([(-50.0, low + 50), (40.0, 40 - high)], key=repr)
    assert quantiles.centre(df, "v").first() == (np.mean(values), np.median(values))
    with pytest.raises(ValueError):
        quantiles.percentiles(df.where("false"), "v", [0.5])


@pytest.mark.parametrize("values", [
    [-1.7e308, 1.7e308, 0.0, 1.0], [5e-324, 1e-323, 1.5e-323, 2e-323, 4e-320], [float("inf"), 1.0, 2.0], [float("-inf"), float("inf")],
    [float("inf")] * 3, [float("nan"), 3.0, 1.0], [-0.0, 0.0], [10.0**k for k in range(-300, 300, 3)] + [-(10.0**k) for k in range(-300, 300, 7)],
    [1.0 + k * 2.0**-52 for k in range(50)],
])
def test_percentiles_end_on_any_values(spark, monkeypatch, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    known = sorted(v for v in values if v == v)
    passes = []
    monkeypatch.setattr(quantiles, "_cell", lambda *a, f=quantiles._cell: passes.append(a[1]) or f(*a))
    for p in (0.0, 0.25, 0.5, 0.75, 1.0):
        passes.clear()
        (got,) = quantiles.percentiles(df, "v", [p])
        spot = (len(known) - 1) * p
        low, high = known[math.floor(spot)], known[math.ceil(spot)]
        if low == high or spot == math.floor(spot):
            assert got == low
        elif math.isinf(low) or math.isinf(high):
            assert got == low + high or (math.isnan(got) and math.isnan(low + high))
        else:
            assert low <= got <= high
        assert len(passes) <= 10  # two ranks, five passes each after the first


def test_centre_leaves_out_what_the_median_leaves_out(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert tuple(quantiles.centre(df, "v").first()) == (2.0, 2.0)
