import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkkit.operators import regression

# Published moments: trips, mean x, mean x², mean xy, mean y, mean y².
N, MX, MXX, MXY, MY, MYY = 7264388, 12.28232223967111, 173.48577192527353, 522.3364483276612, 38.15268375808104, 1636.0517492551535


def moments():
    return N * np.array([[1, MX, MY], [MX, MXX, MXY], [MY, MXY, MYY]])


def test_published_line(spark):
    sums = spark.createDataFrame([(N, N * MX, N * MY, N * MXY, N * MXX)], "n long, sx double, sy double, sxy double, sxx double")
    row = regression.line_from_sums(sums).first()
    assert row.slope == pytest.approx(2.3743748579662416, rel=1e-10)
    assert row.intercept == pytest.approx(8.989846634766463, rel=1e-10)


def test_published_descent():
    result = regression.descend(moments(), 0.1, 1e-4, 100)
    assert result.weights[1] == pytest.approx(2.9512348284447425, abs=1e-9)
    assert result.weights[0] == pytest.approx(0.8478908679858951, abs=1e-9)
    assert result.rate == pytest.approx(0.012523929318695611, rel=1e-9)
    assert result.trace[0][1] == pytest.approx(11085052384.18, rel=1e-9)
    assert result.trace[99][1] == pytest.approx(447076984.26, rel=1e-8)
    costs = [t[1] for t in result.trace]
    assert all(b < a for a, b in zip(costs, costs[1:]))
    assert result.trace[0][2] == 1e-4 and result.trace[1][2] == pytest.approx(1.05e-4)


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 3, size=(300, 4))
    y = x @ [1.0, -2.0, 0.5, 3.0] + 4 + rng.normal(size=300)
    data = [(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 1.0)]
    return spark.createDataFrame(data, "a double, b double, c double, d double, y double").repartition(3), x, y


def test_descent_equals_row_by_row(sample):
    df, x, y = sample
    result = regression.descend(regression.gram(df, ["a", "b", "c", "d"], "y"), 0.1, 0.2, 30)
    w, b, rate, old = np.full(4, 0.1), 0.1, 0.2, None
    for number, cost_seen, rate_seen, _ in result.trace:
        error = y - (x @ w + b)
        cost = float(error @ error)
        w, b = w + rate * 2 / len(y) * (x.T @ error), b + rate * 2 / len(y) * error.sum()
        if old is not None:
            rate *= 1.05 if cost < old else 0.5 if cost > old else 1
        old = cost
        assert cost_seen == pytest.approx(cost, rel=1e-7) and rate_seen == pytest.approx(rate)
    assert result.weights == pytest.approx(np.append(b, w), rel=1e-6)
    assert any(a[2] > b[2] for a, b in zip(result.trace, result.trace[1:])), "a rise in cost halves the rate"


def test_long_descent_reaches_least_squares(sample, spark):
    df, x, y = sample
    exact = np.linalg.lstsq(np.c_[np.ones(len(y)), x], y, rcond=None)[0]
    matrix = regression.gram(df, ["a", "b", "c", "d"], "y")
    result = regression.descend(matrix, 0.0, 0.01, 3000)
    assert result.weights == pytest.approx(exact, abs=1e-3)
    assert regression.squared_error(matrix, exact) <= result.trace[-1][1] + 1e-9
    assert result.frame(spark).count() == 3000


def test_line_and_error(sample):
    df, x, y = sample
    slope, intercept = np.polyfit(x[:, 0], y, 1)
    row = regression.fit_line(df, "a", "y").first()
    assert (row.n, row.slope, row.intercept) == (300, pytest.approx(slope), pytest.approx(intercept))
    sse = regression.sum_of_squares(df, "y", F.col("a") * row.slope + row.intercept).first().sse
    assert sse == pytest.approx(float(np.sum((y - slope * x[:, 0] - intercept) ** 2)))


def test_bold_driver_rules():
    driver = regression.BoldDriver(1.0)
    assert [driver.observe(c) for c in (5, 4, 4, 6)] == pytest.approx([1.0, 1.05, 1.05, 0.525])
    assert regression.BoldDriver(1.0, shrink_on_tie=True, last=4).observe(4) == 0.5
