"""Forecast metrics — exact values carried over from the source's unit tests."""

import math

import pytest
from pyspark.sql import functions as F

from barline.operators import metrics as M


def _frame(spark, y, p):
    data = [("a", i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(data, "g string, t long, y_true double, y_pred double")


def _eval(spark, y, p):
    df = _frame(spark, y, p)
    return M.evaluate(df, ["g"], None, ["t"]).collect()[0]


def test_rmse(spark):
    r = _eval(spark, [1, 2, 3], [1, 2, 4])
    assert r["rmse"] == pytest.approx(math.sqrt(1 / 3))
    assert _eval(spark, [1, 2, 3], [1, 2, 3])["rmse"] == 0.0


def test_mae(spark):
    assert _eval(spark, [10, 20, 30], [11, 22, 27])["mae"] == pytest.approx(2.0)


def test_mape(spark):
    assert _eval(spark, [100, 200], [110, 180])["mape"] == pytest.approx(10.0)
    assert _eval(spark, [0, 0], [1, 2])["mape"] == math.inf


def test_minmax_rmse(spark):
    r = _eval(spark, [10, 20, 30, 40, 50], [12, 22, 28, 42, 48])
    assert 0 <= r["minmax_rmse"] <= 1
    assert r["minmax_rmse"] == pytest.approx(2 / 40)
    assert _eval(spark, [5, 5, 5], [4, 5, 6])["minmax_rmse"] == math.inf


def test_directional_accuracy(spark):
    assert _eval(spark, [1, 2, 3, 4], [1, 2.5, 3.5, 5])["directional_accuracy"] == 100.0
    assert _eval(spark, [1, 2, 3], [3, 2, 1])["directional_accuracy"] == 0.0
    assert _eval(spark, [1], [1])["directional_accuracy"] == 0.0


def test_directional_accuracy_zero_sign_is_own_class(spark):
    # changes: y: 0, +1 ; p: 0, -1  → first pair matches (0 == 0), second does not
    assert _eval(spark, [1, 1, 2], [1, 1, 0])["directional_accuracy"] == 50.0


def test_blocked_da_equals_window_da(spark):
    rows = [("a", i // 3, i, float((i * 7) % 11), float((i * 5) % 13)) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, blk long, t long, y_true double, y_pred double")
    a = M.directional_accuracy(df, ["g"], "blk", ["t"]).collect()[0][1]
    b = M.directional_accuracy(df, ["g"], None, ["t"]).collect()[0][1]
    assert a == pytest.approx(b)


def test_correlation_is_stable_and_pairwise_complete(spark):
    import numpy as np

    from barline.operators.explore import correlation_pairs

    rng = np.random.default_rng(2)
    a = 1e9 + rng.normal(size=400)
    b = 1e9 + 0.5 * (a - 1e9) + rng.normal(size=400)
    c = rng.normal(size=400)
    rows = [(float(x), None if i % 7 == 0 else float(y), float("nan") if i % 5 == 0 else float(z), 3.0)
            for i, (x, y, z) in enumerate(zip(a, b, c))]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_pairs(frame, ["a", "b", "c", "d"]).collect()}
    i = np.arange(400)
    for (x, y), (u, v), keep in ((("b", "a"), (b, a), i % 7 != 0), (("c", "a"), (c, a), i % 5 != 0),
                                 (("c", "b"), (c, b), (i % 7 != 0) & (i % 5 != 0))):
        assert abs(got[x, y] - np.corrcoef(u[keep], v[keep])[0, 1]) < 1e-6
    assert got["d", "a"] is None and len(got) == 6
