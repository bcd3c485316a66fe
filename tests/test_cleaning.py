"""Cleaning rules: numeric text, header names, bar shaping, sanitisers."""

import pytest
from pyspark.sql import functions as F

from barline.functions import names as N
from barline.functions.numeric import clean_numeric
from barline.operators import cleaning as C


@pytest.mark.parametrize("text,expected", [
    ("1.5M", 1_500_000.0), ("2M", 2_000_000.0), ("1B", 1e9), ("$1,234.56", 1234.56),
    ("invalid", None), ("invalidM", None), ("invalidB", None), ("nan", None), (None, None),
    ("100", 100.0), ("12.5%", 12.5), (' "7" ', 7.0), ("1.5M%", None), ("3K", None),
    ("-2.25", -2.25), ("1_000", 1000.0), ("1e3", 1000.0), ("m5", 5_000_000.0),
])
def test_clean_numeric(spark, text, expected):
    df = spark.createDataFrame([(text,)], "raw string")
    got = df.select(clean_numeric("raw").alias("v")).collect()[0]["v"]
    assert got == (pytest.approx(expected) if expected is not None else None)


def test_clean_numeric_inf(spark):
    df = spark.createDataFrame([("inf",), ("-Infinity",)], "raw string")
    got = [r["v"] for r in df.select(clean_numeric("raw").alias("v")).collect()]
    assert got == [float("inf"), float("-inf")]


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Chg_%` int, `Price (USD)` int, `Vol.` int")
    out = C.clean_columns(df).columns
    assert out == ["chg_", "priceusd", "vol"]
    assert all(ch.isalnum() or ch == "_" for c in out for ch in c)


def test_header_synonyms_before_stripping(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Chg_%` int, `Chg_` int, `Volume` int")
    assert C.clean_columns(df, N.HEADER_SYNONYMS).columns == ["chg_pct", "chg_abs", "vol"]


def test_duplicate_columns_raise(spark):
    df = spark.createDataFrame([(1, 2)], "`A!` int, `a` int")
    with pytest.raises(C.DuplicateColumnError):
        C.clean_columns(df)


def test_bar_changes_and_stock_shape(spark):
    df = spark.createDataFrame([("AAPL", "2024-01-01", 100.0, 106.0, 99.0, 105.0, 1000)],
                               "asset_name string, Date string, Open double, High double, Low double, Close double, Volume long")
    s = C.stock_shape(C.normalise_bars(df)).collect()[0]
    assert s["chg_abs"] == 5.0 and s["last"] == 105.0 and s["chg_pct"] == pytest.approx(5.0)
    assert s["name"] == "AAPL"


def test_open_zero_gives_null_pct(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "Open double, Close double")
    r = C.bar_changes(df).collect()[0]
    assert r["chg_abs"] == 1.0 and r["chg_pct"] is None


def test_crypto_symbol_and_proxies(spark):
    rows = [("BTC-USD", i, float(10 + i), 5) for i in range(9)]
    df = spark.createDataFrame(rows, "asset_name string, timestamp long, Close double, Volume long") \
        .withColumn("Open", F.col("Close"))
    out = C.crypto_shape(df).orderBy("timestamp").collect()
    assert out[0]["symbol"] == "BTC"
    assert out[0]["market_cap"] == pytest.approx(10e6)
    assert out[0]["total_vol"] == out[0]["vol_24h"] == 5
    assert out[6]["chg_7d"] is None and out[7]["chg_7d"] == pytest.approx((17 / 10 - 1) * 100)


def test_multilevel_names(spark):
    df = spark.createDataFrame([(150.0, 149.0)], "`('Close', 'AAPL')` double, `('Open', 'AAPL')` double")
    n = C.normalise_bars(df)
    assert n.columns == ["Close", "Open"]
    assert C.stock_shape(n.withColumn("asset_name", F.lit("AAPL"))).collect()[0]["last"] == 150.0


def test_name_columns(spark):
    df = spark.createDataFrame([("S P 500",), ("BTC-USD",), ("A.B/C:D",), ("x%'\"y",), (None,)], "n string")
    n = F.col("n")
    got = [tuple(r) for r in df.select(N.artifact_name_col(n), N.report_name_col(n), N.registry_name_col(n, None, None)).collect()]
    assert got == [("S_P_500", "s_p_500", "s_p_500"), ("BTC_USD", "btc-usd", "btc-usd"), ("A_B_C_D", "a_b/c:d", "a_b/c:d"),
                   ("x___y", "x%'\"y", "x%'\"y"), (None, None, None)]
    named = spark.createDataFrame([("test_model",)], "n string").select(N.registry_name_col(n, "my_catalog", "my_schema")).first()[0]
    assert named == "my_catalog.my_schema.test_model"


def test_preprocess_stocks_drops_missing(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "A", "1.5M"), ("2024-01-02", None, None), ("2024-01-03", "A", "$2")],
        "Timestamp string, Name string, Last string")
    out = C.preprocess_stocks(df).orderBy("timestamp").collect()
    assert [r["last"] for r in out] == [1_500_000.0, 2.0]


def test_preprocess_crypto_all_null(spark):
    df = spark.createDataFrame([("2024-01-01", None, None)], "timestamp string, name string, price_usd double")
    assert C.preprocess_crypto(df).count() == 0


def test_to_numeric_coerce(spark):
    from barline.functions.numeric import to_numeric

    df = spark.createDataFrame([(" 1.5 ",), ("abc",), ("2e2",), (None,), ("1,000",)], "s string")
    assert [r[0] for r in df.select(to_numeric("s")).collect()] == [1.5, None, 200.0, None, None]


def test_chg_7d_pads_before_dividing(spark):
    # pandas default pct_change fills gaps first: [1, null, 4] over 1 period → 0.0, 3.0
    rows = [("A-USD", 0, 1.0), ("A-USD", 1, None), ("A-USD", 2, 4.0)] + [("A-USD", i, 4.0) for i in range(3, 9)]
    df = spark.createDataFrame(rows, "asset_name string, timestamp long, Close double") \
        .withColumn("Open", F.lit(1.0)).withColumn("Volume", F.lit(1))
    out = C.crypto_shape(df).orderBy("timestamp").collect()
    assert out[7]["chg_7d"] == pytest.approx((4.0 / 1.0 - 1) * 100)   # 7 rows back is the first close
    assert out[8]["chg_7d"] == pytest.approx((4.0 / 1.0 - 1) * 100)   # 7 rows back is the gap, padded with 1.0


def test_nan_becomes_null(spark):
    from barline.sources.tables import nan_to_null

    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert [r["x"] for r in nan_to_null(df).orderBy("k").collect()] == [None, 2.0]


def test_numeric_text_white_space_and_underscores(spark):
    from barline.functions.numeric import clean_numeric, to_numeric

    texts = ["\t5\n", " 7 ", "1_000", "1__0", "$1_000M\n", "inf", None, "x"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.orderBy("i").select(clean_numeric("t").alias("c"), to_numeric("t").alias("n")).collect()
    assert [r["c"] for r in got] == [5.0, 7.0, 1000.0, None, 1e9, float("inf"), None, None]
    assert [r["n"] for r in got] == [5.0, 7.0, None, None, None, float("inf"), None, None]
