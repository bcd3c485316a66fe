"""Indicators against an independent pandas recomputation (published definitions)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.config import FeatureConfig
from barline.operators.calendar import daily_resample
from barline.operators.indicators import add_indicators, position
from barline.operators.linear_scan import Average, ema_scan, span_alpha
from barline.plans.features import feature_table

CFG = FeatureConfig()


def _series(n=120, seed=7):
    rng = np.random.default_rng(seed)
    return 100 + np.cumsum(rng.normal(0, 1, n))


def _pandas_reference(close: pd.Series, cfg: FeatureConfig) -> pd.DataFrame:
    d = pd.DataFrame({"close": close})
    d["return"] = d.close / d.close.shift(1) - 1
    d["log_return"] = np.log(d.close / d.close.shift(1))
    for n in cfg.moving_averages:
        d[f"ma_{n}"] = d.close.rolling(n).mean()
    fast = d.close.ewm(span=cfg.macd_fast, adjust=False, min_periods=cfg.macd_fast).mean()
    slow = d.close.ewm(span=cfg.macd_slow, adjust=False, min_periods=cfg.macd_slow).mean()
    d["macd"] = fast - slow
    d["macd_signal"] = d.macd.ewm(span=cfg.macd_signal, adjust=False, min_periods=cfg.macd_signal).mean()
    d["macd_diff"] = d.macd - d.macd_signal
    diff = d.close.diff(1)
    up = diff.where(diff > 0, 0.0).ewm(alpha=1 / cfg.rsi_window, adjust=False, min_periods=cfg.rsi_window).mean()
    dn = (-diff.where(diff < 0, 0.0)).ewm(alpha=1 / cfg.rsi_window, adjust=False, min_periods=cfg.rsi_window).mean()
    d["rsi"] = np.where(dn == 0, 100, 100 - 100 / (1 + up / dn))
    d.loc[dn.isna(), "rsi"] = np.nan
    m = d.close.rolling(cfg.bollinger_window).mean()
    s = d.close.rolling(cfg.bollinger_window).std(ddof=0)
    d["bb_high"], d["bb_low"] = m + cfg.bollinger_dev * s, m - cfg.bollinger_dev * s
    d["bb_width"] = (d.bb_high - d.bb_low) / d.close.replace(0, np.nan)
    d["bb_position"] = (d.close - d.bb_low) / (d.bb_high - d.bb_low).replace(0, np.nan)
    d[f"volatility_{cfg.volatility_window}"] = d.close.rolling(cfg.volatility_window).std()
    for k in cfg.lags:
        d[f"lag_{k}"] = d.close.shift(k)
    d["target"] = d.close.shift(-1)
    return d


def _daily_frame(spark, values, asset="X"):
    start = pd.Timestamp("2024-01-01")
    rows = [(asset, (start + pd.Timedelta(days=i)).date(), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "asset_name string, day date, close double")


def test_indicators_match_pandas(spark):
    vals = _series()
    got = add_indicators(_daily_frame(spark, vals), CFG).orderBy("day").toPandas()
    ref = _pandas_reference(pd.Series(vals), CFG)
    for col in ref.columns:
        a, b = got[col].to_numpy(dtype=float), ref[col].to_numpy(dtype=float)
        assert np.array_equal(np.isnan(a), np.isnan(b)), col
        m = ~np.isnan(a)
        assert np.allclose(a[m], b[m], rtol=1e-9, atol=1e-9), col


def test_warm_up_nulls(spark):
    got = add_indicators(_daily_frame(spark, _series(60)), FeatureConfig(moving_averages=(50,))).orderBy("day").collect()
    assert got[0]["rsi"] is None and got[0]["ma_50"] is None
    assert got[48]["ma_50"] is None and got[49]["ma_50"] is not None
    # MACD signal first value at row slow + signal - 2 (0-based)
    first = next(i for i, r in enumerate(got) if r["macd_signal"] is not None)
    assert first == CFG.macd_slow + CFG.macd_signal - 2


def test_ema_scan_matches_pandas(spark):
    vals = _series(400)
    df = _daily_frame(spark, vals)
    got = ema_scan(df, ["asset_name"], position(df, "day"), {"e": Average("close", span_alpha(12), 12)}).orderBy("day").toPandas()["e"]
    ref = pd.Series(vals).ewm(span=12, adjust=False, min_periods=12).mean()
    assert np.allclose(got.to_numpy(dtype=float)[11:], ref.to_numpy()[11:], rtol=1e-12)
    assert got[:11].isna().all()


def test_indicators_of_several_assets_and_blocks_with_leading_nulls(spark):
    """Series of several blocks per asset, one without prices at its start, one flat."""
    series = {"A": _series(500, 1), "B": np.concatenate([[np.nan] * 70, _series(200, 2)]), "C": np.full(150, 5.0)}
    df = None
    for name, vals in series.items():
        part = _daily_frame(spark, vals, name).withColumn("close", F.nanvl("close", F.lit(None).cast("double")))
        df = part if df is None else df.unionByName(part)
    got = add_indicators(df.repartition(7), CFG).toPandas()
    for name, vals in series.items():
        mine, first = got[got.asset_name == name].sort_values("day"), int(np.isnan(vals).sum())
        ref = _pandas_reference(pd.Series(vals), CFG)
        for col in ("macd", "macd_signal", "macd_diff"):
            a, b = mine[col].to_numpy(dtype=float), ref[col].to_numpy(dtype=float)
            assert np.array_equal(np.isnan(a), np.isnan(b)), (name, col)
            assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)], rtol=1e-9, atol=1e-9), (name, col)
        a, b = mine["rsi"].to_numpy(dtype=float)[first + CFG.rsi_window:], ref["rsi"].to_numpy(dtype=float)[first + CFG.rsi_window:]
        if not first:  # gains start at the first price; before it pandas counts rows without one as zero gains
            assert np.allclose(a, b, rtol=1e-9, atol=1e-9), name


def test_zero_price_rules(spark):
    got = add_indicators(_daily_frame(spark, [0.0, 2.0, 0.0, 0.0]), CFG).orderBy("day").collect()
    assert got[1]["return"] == math.inf and got[1]["log_return"] == math.inf
    assert got[2]["return"] == -1.0 and got[2]["log_return"] == -math.inf
    assert got[3]["return"] is None  # 0/0 is missing


def test_resample_fills_calendar_and_takes_last(spark):
    rows = [("A", "2024-01-01 10:00:00", 1, 1.0), ("A", "2024-01-01 09:00:00", 2, 5.0),
            ("A", "2024-01-01 10:00:00", 3, 2.0), ("A", "2024-01-04 08:00:00", 4, 4.0),
            ("A", "2024-01-05 08:00:00", 5, None)]
    df = spark.createDataFrame(rows, "asset_name string, ts string, tie long, price double") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))
    got = [(str(r["day"]), r["close"]) for r in daily_resample(df).orderBy("day").collect()]
    assert got == [("2024-01-01", 2.0), ("2024-01-02", 2.0), ("2024-01-03", 2.0), ("2024-01-04", 4.0)]


def test_feature_table_drops_incomplete_rows(spark):
    vals = _series(80)
    rows = [("X", "stock", (pd.Timestamp("2024-01-01") + pd.Timedelta(days=i)).to_pydatetime(), i, float(v))
            for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "asset_name string, asset_type string, ts timestamp_ntz, tie long, price double")
    ft = feature_table(df, CFG)
    n = ft.count()
    # first complete row: max(ma 14 → 13, signal → 12+3-2=13, vol → 6, bb → 9); last row has no target
    assert n == 80 - 14
    assert ft.where(F.col("asset_type") != "stock").count() == 0


def test_not_found_and_all_null_give_empty(spark):
    df = spark.createDataFrame([("Y", "2024-01-01", 1, None)], "asset_name string, ts string, tie long, price double") \
        .withColumn("ts", F.to_timestamp_ntz("ts"))
    assert feature_table(df, CFG, asset_type=None).count() == 0
    assert feature_table(df.where("asset_name = 'Z'"), CFG, asset_type=None).count() == 0


def test_feature_table_configured_assets_only(spark):
    from barline.config import Config, asset_frame

    vals = _series(40)
    rows = [(a, (pd.Timestamp("2024-01-01") + pd.Timedelta(days=i)).to_pydatetime(), i, str(v))
            for a in ("A", "B") for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "asset_name string, ts timestamp_ntz, tie long, price string")
    ft = feature_table(df, CFG, assets=asset_frame(spark, Config(stocks=(), cryptos=("B",))))
    got = {(r["asset_name"], r["asset_type"]) for r in ft.select("asset_name", "asset_type").distinct().collect()}
    assert got == {("B", "crypto")}
