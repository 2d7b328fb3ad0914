"""The fit by Newton steps against one in plain numpy."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from sparkpipe.operators import score


def plain(rows, rounds, penalty):
    x = np.array([[1.0, *r[:-1]] for r in rows])
    y = np.array([float(r[-1]) for r in rows])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        step = x.T @ (p - y) / len(y) + penalty * w
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + penalty * np.eye(len(w)), step)
    return w


@pytest.mark.parametrize("seed", range(2))
def test_weights(spark, seed):
    chance = np.random.default_rng(seed)
    x = chance.normal(size=(400, 2))
    y = (x[:, 0] - 0.5 * x[:, 1] + chance.normal(size=400) > 0).astype(int)
    rows = [(float(a), float(b), int(c)) for (a, b), c in zip(x, y)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1), (1.0, 2.0, None)], "a double, b double, label int")
    intercept, weights = score.fit_newton(df, ["a", "b"], rounds=8, penalty=0.05)
    want = plain(rows, 8, 0.05)
    assert np.allclose([intercept, weights["a"], weights["b"]], want, atol=1e-9)
    p = 1 / (1 + np.exp(-(np.c_[np.ones(400), x] @ want)))
    rest = np.c_[np.ones(400), x].T @ (p - y) / 400 + 0.05 * want
    assert np.abs(rest).max() < 1e-9  # the last step stands still


def test_nothing_to_tell_apart(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 0)], "a double, label int")
    assert score.fit_newton(df, ["a"]) is None
    assert score.fit_newton(df.limit(0), ["a"]) is None


def test_labels_without_overlap_stay_finite(spark):
    df = spark.createDataFrame([(float(i), int(i > 5)) for i in range(12)], "a double, label int")
    intercept, weights = score.fit_newton(df, ["a"], rounds=12)
    assert np.isfinite(intercept) and weights["a"] > 0


def test_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        made.add(1)
        return float(x)

    df = spark.range(40).select(counted("id").alias("a"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    assert score.fit_newton(df, ["a"], rounds=4) is not None
    # Python may be asked twice for a row: for the column, and by the filter on it.
    assert made.value <= 80
