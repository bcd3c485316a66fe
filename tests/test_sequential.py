"""Block-wise lag / row_number equal the plain single-partition windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from barline.operators.sequential import blocked_ffill, blocked_lag, blocked_row_number, blocked_shift, top_k_per_group


def _data(spark):
    rows = [(k, d, t, float((t * 13 + d * 7) % 97)) for k in ("a", "b") for d in range(6) for t in range(d % 3 + 1)]
    # block 3 of key a is missing entirely (gap between blocks)
    rows = [r for r in rows if not (r[0] == "a" and r[1] == 3)]
    return spark.createDataFrame(rows, "k string, blk int, t int, v double")


def test_blocked_lag_equals_window(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("blk", "t")
    ref = {(r.k, r.blk, r.t): r.p for r in df.select("k", "blk", "t", F.lag("v").over(w).alias("p")).collect()}
    got = {(r.k, r.blk, r.t): r.v_prev for r in blocked_lag(df, ["k"], "blk", ["blk", "t"], ["v"]).collect()}
    assert got == ref


def test_blocked_row_number_equals_window(spark):
    df = _data(spark)
    w = Window.partitionBy("k").orderBy("blk", "t")
    ref = {(r.k, r.blk, r.t): r.n for r in df.select("k", "blk", "t", F.row_number().over(w).alias("n")).collect()}
    got = {(r.k, r.blk, r.t): r.rn for r in blocked_row_number(df, ["k"], "blk", ["blk", "t"], "rn").collect()}
    assert got == ref


def test_top_k(spark):
    df = _data(spark)
    got = top_k_per_group(df, ["k"], [F.col("blk").desc(), F.col("t").desc()], 2, "r").collect()
    assert sorted((r.k, r.r) for r in got) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def _holes(spark):
    """Two keys and a null key; blocks of one to nine rows, some of nulls only, one block missing."""
    rows = [(k, d, t, None if (t * 7 + d * 3) % 4 == 0 or d in (2, 5) else float(t * 13 + d))
            for k in ("a", "b", None) for d in range(9) for t in range((d * 5) % 9 + 1) if not (k == "a" and d == 3)]
    return spark.createDataFrame(rows, "k string, blk int, t int, v double").repartition(6)


def test_blocked_shift_and_fill_equal_windows(spark):
    df = _holes(spark)
    w = Window.partitionBy("k").orderBy("blk", "t")
    for k in (1, 3, 7, 40):
        ref = {(r.k, r.blk, r.t): r.p for r in df.select("k", "blk", "t", F.lag("v", k).over(w).alias("p")).collect()}
        out = blocked_shift(df, ["k"], "blk", ["t"], ["v"], k)
        assert out.columns == [*df.columns, "v_prev"]
        assert {(r.k, r.blk, r.t): r.v_prev for r in out.collect()} == ref, k
    filled = F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ref = {(r.k, r.blk, r.t): r.p for r in df.select("k", "blk", "t", filled.alias("p")).collect()}
    out = blocked_ffill(df, ["k"], "blk", ["t"], ["v"])
    assert {(r.k, r.blk, r.t): r.v_filled for r in out.collect()} == ref
    assert blocked_ffill(df.limit(0), ["k"], "blk", ["t"], ["v"]).count() == blocked_shift(df.limit(0), ["k"], "blk", ["t"], ["v"], 2).count() == 0


def test_seven_row_change_on_bars_with_missing_closes(spark):
    """chg_7d of hourly bars equals pandas on every asset, across days and gaps in the closes."""
    import numpy as np
    import pandas as pd

    from barline.operators.cleaning import crypto_shape

    rng = np.random.default_rng(3)
    rows = []
    for name, n in (("BTC-USD", 200), ("ETH-USD", 9), ("X-USD", 40)):
        at = pd.date_range("2024-01-01", periods=n, freq="5h")
        rows += [(name, t.to_pydatetime(), 1.0, 1.0, 1.0, None if rng.random() < 0.3 else float(c), 5)
                 for t, c in zip(at, rng.integers(1, 90, n))]
    bars = spark.createDataFrame(rows, "asset_name string, timestamp timestamp_ntz, Open double, High double, Low double, Close double, Volume long")
    got = crypto_shape(bars.repartition(5)).toPandas().sort_values(["name", "timestamp"])
    frame = pd.DataFrame(rows, columns=["n", "t", "o", "h", "l", "c", "v"]).sort_values(["n", "t"])
    want = frame.groupby("n")["c"].transform(lambda s: (s.ffill() / s.ffill().shift(7) - 1) * 100).to_numpy()
    assert np.allclose(got["chg_7d"].to_numpy(dtype=float), want, equal_nan=True)


def test_a_hot_asset_is_spread_over_blocks(spark):
    out = blocked_shift(_holes(spark), ["k"], "blk", ["t"], ["v"], 7)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shuffles = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(k" in ln]
    assert any("blk" in ln for ln in shuffles) and "Python" not in plan
