"""Blocked EMA scans equal the row-by-row recursion, over many blocks, with nulls and odd keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from barline.operators.linear_scan import Average, ema_scan, span_alpha


def recursion(values, alpha, fewest):
    e, n, out = None, 0, []
    for v in values:
        if v is not None:
            e, n = v if e is None else (1 - alpha) * e + alpha * v, n + 1
        out.append(e if n >= max(1, fewest) else None)
    return out


def series():
    rng = random.Random(4)
    out = {"long": [100 + rng.gauss(0, 5) for _ in range(700)], "one": [3.0], "flat": [7.0] * 90, "none": [None] * 70,
           "late": [None] * 130 + [rng.random() for _ in range(200)], None: [rng.random() * 1e9 for _ in range(150)],
           "holes": [None if rng.random() < 0.5 else rng.gauss(0, 1) for _ in range(300)], "zero": [0.0] * 100 + [1.0] * 30}
    out["gap"] = out["long"][:200]
    return out


@pytest.mark.parametrize("width,levels", [(64, 0), (8, 2), (5, 1), (16, 3)])
def test_scan_equals_the_recursion(spark, width, levels):
    data = series()
    rows = [(k, i * (3 if k == "gap" else 1) - 350, v, "x") for k, vs in data.items() for i, v in enumerate(vs)]  # negative positions too
    df = spark.createDataFrame(rows, "k string, t long, v double, other string").repartition(5)
    wanted = {"slow": ("v", span_alpha(26), 26), "rsi": ("v", 1 / 14, 0), "last": ("v", 1.0, 3), "hard": ("v", 0.9999, 1)}
    averages = {n: Average(*w) for n, w in wanted.items()}
    got = {}
    for r in ema_scan(df, ["k"], F.col("t"), averages, width, levels).collect():
        got.setdefault(r["k"], []).append(r)
    for k, values in data.items():
        mine = sorted(got[k], key=lambda r: r["t"])
        assert len(mine) == len(values)
        for name, (_, alpha, fewest) in wanted.items():
            for r, e in zip(mine, recursion(values, alpha, fewest)):
                assert (r[name] is None) == (e is None), (k, name, r["t"])
                assert e is None or math.isclose(r[name], e, rel_tol=1e-12, abs_tol=1e-12), (k, name, r["t"])


def test_scan_keeps_columns_and_empty_input(spark):
    df = spark.createDataFrame([], "k string, t long, v double")
    out = ema_scan(df, ["k"], F.col("t"), {"e": Average("v", 0.5)})
    assert out.columns == ["k", "t", "v", "e"] and out.count() == 0


def test_a_hot_key_is_split_over_tasks(spark):
    """The rows of one key are partitioned by (key, block); only block summaries meet by key."""
    df = spark.range(5000).select(F.concat(F.lit("hot"), (F.col("id") * 0).cast("string")).alias("k"), F.col("id").alias("t"), F.rand(1).alias("v"))
    out = ema_scan(df, ["k"], F.col("t"), {"e": Average("v", 0.2)}, levels=1)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Python" not in plan and "Pandas" not in plan
    rows = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(" in ln]
    assert rows and any("_block" in ln for ln in rows)
