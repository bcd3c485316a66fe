"""Scaling, look-back sequences, chronological splits."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.operators import sequences as SQ


def _panel(spark, n, asset="X"):
    start = pd.Timestamp("2024-01-01")
    rows = [(asset, (start + pd.Timedelta(days=i)).date(), float(100 + (i * 37) % 17)) for i in range(n)]
    return spark.createDataFrame(rows, "asset_name string, day date, close double")


def _scaled(spark, n):
    f = SQ.minmax_fit(_panel(spark, n))
    return f.withColumn("scaled", SQ.scale(F.col("close"), F.col("x_min"), F.col("x_max")))


def test_sequences_count_and_range(spark):
    s = SQ.lookback(_scaled(spark, 100), 10)
    assert s.count() == 90
    vals = [v for r in s.select("seq").collect() for v in r[0]]
    assert min(vals) >= 0.0 and max(vals) <= 1.0
    assert all(len(r[0]) == 10 for r in s.select("seq").collect())


def test_sequence_content_and_alignment(spark):
    sc = _scaled(spark, 30).orderBy("day").collect()
    first = SQ.lookback(_scaled(spark, 30), 10).orderBy("seq_idx").first()
    assert first["seq_idx"] == 1
    assert first["seq"] == pytest.approx([r["scaled"] for r in sc[:10]])
    assert first["day"] == sc[10]["day"]  # label row is the 11th row
    live = SQ.lookback(_scaled(spark, 30), 10, include_current=True).orderBy("seq_idx").first()
    assert live["seq"] == pytest.approx([r["scaled"] for r in sc[:10]]) and live["day"] == sc[9]["day"]


def test_constant_column_scales_to_zero(spark):
    rows = [("X", pd.Timestamp("2024-01-01").date(), 5.0), ("X", pd.Timestamp("2024-01-02").date(), 5.0)]
    df = SQ.minmax_fit(spark.createDataFrame(rows, "asset_name string, day date, close double"))
    got = df.select(SQ.scale(F.col("close"), F.col("x_min"), F.col("x_max"))).collect()
    assert [r[0] for r in got] == [0.0, 0.0]


def test_inverse_scaling(spark):
    df = _scaled(spark, 20).select("close", SQ.unscale(F.col("scaled"), F.col("x_min"), F.col("x_max")).alias("back"))
    for r in df.collect():
        assert r["back"] == pytest.approx(r["close"])


def _split_sizes(spark, n, ratios):
    df = spark.createDataFrame([("X", i + 1) for i in range(n)], "asset_name string, seq_idx int")
    out = SQ.chrono_split(df, ratios).groupBy("split").count().collect()
    return {r["split"]: r["count"] for r in out}


def test_split_60_20_20(spark):
    assert _split_sizes(spark, 100, (0.6, 0.2)) == {"train": 60, "val": 20, "test": 20}


def test_split_too_small_or_empty(spark):
    assert _split_sizes(spark, 4, (0.6, 0.2)) == {}
    assert _split_sizes(spark, 6, (0.99, 0.001)) == {}


def test_split_80_20(spark):
    assert _split_sizes(spark, 10, (0.8,)) == {"train": 8, "test": 2}


def test_feature_columns_exclusions(spark):
    df = spark.createDataFrame([(1.0, "a", "stock", 2.0, 3.0, 0.5)],
                               "target double, asset_name string, asset_type string, close double, feature1 double, lstm_pred double")
    assert SQ.feature_columns(df) == ["feature1", "lstm_pred"]
