"""Query catalog: every registered operator as (spark, sf_dir) -> DataFrame,
plus the matching DuckDB oracle SQL.

Registered queries are *reports* over an operator: they read the whole driver
tables through the fixture views, run the operator, and round floating
columns to ``ROUND`` digits so two engines' last-bit differences do not
change the value hash.  Column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.config import FeatureConfig
from barline.operators.calendar import daily_resample
from barline.operators.indicators import add_indicators
from barline.plans import oracle as O
from barline.plans.features import feature_table
from barline.session import configure, materialize
from barline.sources import fixtures as fx

ROUND = O.ROUND
FEATURES = FeatureConfig()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def rounded(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every DOUBLE column (reports only; operators keep full precision)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_resample(fx.prices(spark, sf), attrs=("asset_type",))


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return add_indicators(_daily(spark, sf), FEATURES)


def _ind_sql(cols: list[str], where: str = "") -> str:
    ctes, name = O.indicator_select(FEATURES)
    sel = ", ".join(["asset_name", "day"] + [f'{O.r(c)} AS "{c}"' for c in cols])
    return O.with_views(["daily"], ctes, f"SELECT {sel} FROM {name} {where}", recursive=True)


# ------------------------------------------------------------ calendar ----
@register("daily_resample", O.with_views(
    ["daily"], [], f"SELECT asset_name, asset_type, day, {O.r('close')} AS close FROM daily"))
def q_daily_resample(spark, sf):
    """A1+W16+J3: last price per calendar day, all days, forward filled."""
    return rounded(_daily(spark, sf).select("asset_name", "asset_type", "day", "close"))


# ---------------------------------------------------------- indicators ----
def _indicator_query(name: str, cols: list[str]):
    @register(name, _ind_sql(cols))
    def q(spark, sf):
        return rounded(_panel(spark, sf).select("asset_name", "day", *cols))

    q.__doc__ = f"Indicator columns {cols} over the daily panel."
    return q


_indicator_query("returns", ["return", "log_return"])
_indicator_query("moving_averages", [f"ma_{n}" for n in FEATURES.moving_averages])
_indicator_query("macd", ["macd", "macd_signal", "macd_diff"])
_indicator_query("rsi", ["rsi"])
_indicator_query("bollinger", ["bb_high", "bb_low", "bb_width", "bb_position"])
_indicator_query("volatility", [f"volatility_{FEATURES.volatility_window}"])
_indicator_query("lags_target", [f"lag_{k}" for k in FEATURES.lags] + ["target"])


@register("ema", O.with_views(["daily"], O.ema_recursive_ctes(FEATURES), f"""
SELECT d.asset_name, d.day, {O.r('m.ema_fast')} AS ema_fast, {O.r('m.ema_slow')} AS ema_slow
FROM (SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY day) AS rn FROM daily) d
JOIN ema_macd m ON m.asset_name = d.asset_name AND m.rn = d.rn""", recursive=True))
def q_ema(spark, sf):
    """Fast and slow EMA of the daily close (span = MACD fast/slow), per-asset O(n) kernel."""
    from barline.operators.indicators import ema_family

    d = _daily(spark, sf).select("asset_name", "day", "close")
    return rounded(ema_family(d, FEATURES, keep_emas=True).select("asset_name", "day", "ema_fast", "ema_slow"))


FEATURE_COLS = ["close", "return", "log_return", *[f"ma_{n}" for n in FEATURES.moving_averages],
                "macd", "macd_signal", "macd_diff", "rsi", "bb_high", "bb_low", "bb_width", "bb_position",
                f"volatility_{FEATURES.volatility_window}", *[f"lag_{k}" for k in FEATURES.lags], "target"]


def _feature_sql() -> str:
    ctes, name = O.indicator_select(FEATURES)
    sel = ", ".join(["asset_name", "day"] + [f'{O.r(c)} AS "{c}"' for c in FEATURE_COLS] + ["asset_type"])
    cond = " AND ".join(f'"{c}" IS NOT NULL' for c in FEATURE_COLS)
    return O.with_views(["daily"], ctes, f"SELECT {sel} FROM {name} WHERE {cond}", recursive=True)


@register("feature_table", _feature_sql())
def q_feature_table(spark, sf):
    """W21+W22: the full feature table (rows with any null dropped)."""
    return rounded(feature_table(fx.prices(spark, sf), FEATURES))


# ------------------------------------------------------------ cleaning ----
from barline.operators import cleaning as C  # noqa: E402


@register("bars_normalise", O.with_views(["raw_bars"], [], """
SELECT "Ticker" AS asset_name, "Datetime" AS timestamp, round("Open", 4) AS "Open", round("High", 4) AS "High",
       round("Low", 4) AS "Low", round("Close", 4) AS "Close", "Volume" FROM raw_bars"""))
def q_bars_normalise(spark, sf):
    """Landed bar files → asset_name, timestamp, Open, High, Low, Close, Volume."""
    return rounded(C.normalise_bars(fx.raw_bars(spark, sf)))


@register("bar_changes", O.with_views(["raw_bars"], [], f"""
SELECT "Ticker" AS asset_name, "Datetime" AS timestamp, {O.r('"Close" - "Open"')} AS chg_abs,
       {O.r('("Close" - "Open") / nullif("Open", 0) * 100')} AS chg_pct FROM raw_bars"""))
def q_bar_changes(spark, sf):
    """Absolute and percent bar change (Open = 0 → null)."""
    b = C.bar_changes(C.normalise_bars(fx.raw_bars(spark, sf)))
    return rounded(b.select("asset_name", "timestamp", "chg_abs", "chg_pct"))


_STOCK_COLS = C.STOCK_COLUMNS
_CRYPTO_COLS = C.CRYPTO_COLUMNS


def _sel(cols, table):
    return "SELECT " + ", ".join(
        c if c in ("timestamp", "name", "symbol") else f"{O.r(c)} AS {c}" for c in cols) + f" FROM {table}"


@register("stock_shape", O.with_views(["stock_shaped"], [], _sel(_STOCK_COLS, "stock_shaped")))
def q_stock_shape(spark, sf):
    """P5 (stocks): the stock table layout from bars."""
    return rounded(C.stock_shape(fx.stock_bars(spark, sf)))


@register("crypto_shape", O.with_views(["crypto_shaped"], [], _sel(_CRYPTO_COLS, "crypto_shaped")))
def q_crypto_shape(spark, sf):
    """P3/P4/P5/W15 (crypto): symbol, chg_7d, market-cap proxy, renames."""
    return rounded(C.crypto_shape(fx.crypto_bars(spark, sf)))


@register("union_assets", O.with_views(["stock_shaped", "crypto_shaped"], [], f"""
SELECT timestamp, name, {O.r('last')} AS last, {O.r('high')} AS high, {O.r('low')} AS low,
       {O.r('chg_abs')} AS chg_abs, {O.r('chg_pct')} AS chg_pct, {O.r('vol')} AS vol,
       NULL::VARCHAR AS symbol, NULL::DOUBLE AS price_usd, NULL::BIGINT AS vol_24h, NULL::BIGINT AS total_vol,
       NULL::DOUBLE AS chg_24h, NULL::DOUBLE AS chg_7d, NULL::DOUBLE AS market_cap
FROM stock_shaped
UNION ALL
SELECT timestamp, name, NULL, NULL, NULL, NULL, NULL, NULL, symbol, {O.r('price_usd')}, vol_24h,
       total_vol, {O.r('chg_24h')}, {O.r('chg_7d')}, {O.r('market_cap')}
FROM crypto_shaped"""))
def q_union_assets(spark, sf):
    """Stock and crypto tables stacked by name, missing columns null."""
    s = C.stock_shape(fx.stock_bars(spark, sf))
    c = C.crypto_shape(fx.crypto_bars(spark, sf))
    return rounded(s.unionByName(c, allowMissingColumns=True))


@register("clean_columns", O.with_views(["raw_stocks"], [], """
SELECT "Timestamp" AS timestamp, "Name" AS name, "Last" AS last, round("High", 4) AS high,
       round("Low", 4) AS low, round("Chg_", 4) AS chg_abs, "Chg_%" AS chg_pct, "Vol." AS vol, "Notes" AS notes
FROM raw_stocks"""))
def q_clean_columns(spark, sf):
    """Header synonyms then character stripping; data untouched."""
    from barline.functions.names import HEADER_SYNONYMS

    return rounded(C.clean_columns(fx.raw_stocks(spark, sf), HEADER_SYNONYMS))


@register("clean_numeric", O.with_views(["dirty"], [], f"""
SELECT o_orderkey, raw, {O.r(O.sql_clean_numeric('raw'))} AS value FROM dirty"""))
def q_clean_numeric(spark, sf):
    """Messy numeric text → double (M/B suffixes, $ , % stripped, junk → null)."""
    from barline.functions.numeric import clean_numeric

    d = fx.dirty(spark, sf)
    return rounded(d.select("o_orderkey", "raw", clean_numeric("raw").alias("value")))


@register("to_numeric", O.with_views(["dirty"], [], """
SELECT o_orderkey, raw, round(CASE WHEN regexp_matches(regexp_replace(raw, '^\\s+|\\s+$', '', 'g'),
  '^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST(trim(raw) AS DOUBLE) END, 4) AS value FROM dirty"""))
def q_to_numeric(spark, sf):
    """P10: text price coerced to a number; anything but a plain decimal is null."""
    from barline.functions.numeric import to_numeric

    d = fx.dirty(spark, sf)
    return rounded(d.select("o_orderkey", "raw", to_numeric("raw").alias("value")))


@register("preprocess_stocks", O.with_views(["raw_stocks"], [], f"""
SELECT * FROM (
  SELECT CAST("Timestamp" AS TIMESTAMP) AS timestamp, "Name" AS name,
         {O.r(O.sql_clean_numeric('"Last"'))} AS last, round("High", 4) AS high, round("Low", 4) AS low,
         round("Chg_", 4) AS chg_abs, {O.r(O.sql_clean_numeric('"Chg_%"'))} AS chg_pct,
         {O.r(O.sql_clean_numeric('"Vol."'))} AS vol
  FROM raw_stocks) WHERE last IS NOT NULL AND name IS NOT NULL"""))
def q_preprocess_stocks(spark, sf):
    """P11 (stocks): full cleaning chain on a scraped stock table."""
    return rounded(C.preprocess_stocks(fx.raw_stocks(spark, sf)))


@register("preprocess_crypto", O.with_views(["raw_crypto"], [], f"""
SELECT * FROM (
  SELECT CAST("Timestamp" AS TIMESTAMP) AS timestamp, "Name" AS name, "Symbol" AS symbol,
         {O.r(O.sql_clean_numeric('"Price_USD"'))} AS price_usd, CAST("Vol_24h" AS DOUBLE) AS vol_24h,
         round("Chg_24h", 4) AS chg_24h, {O.r(O.sql_clean_numeric('"Market_Cap"'))} AS market_cap
  FROM raw_crypto) WHERE price_usd IS NOT NULL AND name IS NOT NULL"""))
def q_preprocess_crypto(spark, sf):
    """P11 (crypto): full cleaning chain on a scraped crypto table."""
    return rounded(C.preprocess_crypto(fx.raw_crypto(spark, sf)))


# ------------------------------------------------------------- quality ----
from barline.functions.numeric import clean_numeric  # noqa: E402
from barline.operators import drift as D  # noqa: E402
from barline.operators import explore as X  # noqa: E402
from barline.operators import metrics as M  # noqa: E402
from barline.operators import quality as Q  # noqa: E402
from barline.config import asset_frame  # noqa: E402
from barline.sources.tables import nan_to_null, read_table  # noqa: E402, nan_to_null


def _dirty_stocks(spark, sf):
    d = fx.dirty(spark, sf)
    return d.select(F.col("o_orderdate").alias("timestamp"), F.col("o_orderpriority").alias("name"),
                    clean_numeric("raw").alias("last"), F.col("o_totalprice").alias("high"),
                    F.col("raw").alias("vol"))


def _customer_crypto(spark, sf):
    c = nan_to_null(read_table(spark, sf, "customer", "c_name", "c_acctbal", "c_nationkey"))
    return c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("price_usd"),
                    F.col("c_nationkey").alias("vol_24h"))


def _dq(spark, sf):
    a = Q.validate_dataset(_dirty_stocks(spark, sf), Q.STOCK_RULES, "dirty_stocks")
    b = Q.validate_dataset(_customer_crypto(spark, sf), Q.CRYPTO_RULES, "customer_crypto")
    return a.unionByName(b)


_DQ_CTES = [
    ("ds", f"""SELECT o_orderdate AS timestamp, o_orderpriority AS name, {O.sql_clean_numeric('raw')} AS last,
               o_totalprice AS high, raw AS vol FROM dirty"""),
    ("cc", "SELECT c_name AS name, c_acctbal AS price_usd, c_nationkey AS vol_24h FROM customer"),
    ("dq", O.dq_union("dirty_stocks", "ds", [("last", True), ("high", True), ("vol", False)], 0, 0.1,
                      ["timestamp", "name"])
     + "\nUNION ALL\n"
     + O.dq_union("customer_crypto", "cc", [("price_usd", True), ("vol_24h", True)], 1, 0.1, ["name"])),
]


@register("dq_checks", O.with_views(["dirty"], _DQ_CTES,
                                    "SELECT dataset, check_id, check_name, passed, round(observed, 4) AS observed FROM dq"))
def q_dq_checks(spark, sf):
    """Every validation check of two datasets as rows."""
    return rounded(_dq(spark, sf))


@register("dq_overall", O.with_views(["dirty"], _DQ_CTES, """
SELECT dataset, bool_and(passed) AS passed, count(*) AS n_checks, count(*) FILTER (WHERE NOT passed) AS n_failed
FROM dq GROUP BY dataset"""))
def q_dq_overall(spark, sf):
    """Overall verdict per dataset (AND of its checks), taken while the datasets are written."""
    _, a = Q.write_checked(_dirty_stocks(spark, sf), Q.STOCK_RULES, "dirty_stocks")
    _, b = Q.write_checked(_customer_crypto(spark, sf), Q.CRYPTO_RULES, "customer_crypto")
    return Q.overall(a.unionByName(b))


@register("dq_duplicates", O.with_views(["dirty"], [], """
SELECT 'lineitem' AS dataset, 'l_orderkey,l_linenumber' AS keys, CAST(sum(c) AS BIGINT) AS n_rows,
       CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_dupes, coalesce(sum(c - 1), 0) = 0 AS passed
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL
SELECT 'dirty', 'timestamp,name', CAST(sum(c) AS BIGINT), CAST(coalesce(sum(c - 1), 0) AS BIGINT),
       coalesce(sum(c - 1), 0) = 0
FROM (SELECT count(*) AS c FROM dirty GROUP BY o_orderdate, o_orderpriority)"""))
def q_dq_duplicates(spark, sf):
    """Rows beyond the first per key (nulls equal) on two tables."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    d = fx.dirty(spark, sf).select(F.col("o_orderdate").alias("timestamp"), F.col("o_orderpriority").alias("name"))
    return Q.duplicates_report(li, ["l_orderkey", "l_linenumber"], "lineitem").unionByName(
        Q.duplicates_report(d, ["timestamp", "name"], "dirty"))


def _config_values_sql() -> str:
    cfg = fx.FIXTURE_CONFIG
    rows = [f"('{a}', 'stock', {i})" for i, a in enumerate(cfg.stocks)]
    rows += [f"('{a}', 'crypto', {len(cfg.stocks) + i})" for i, a in enumerate(cfg.cryptos)]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(asset_name, asset_type, pos)"


@register("missing_assets", O.with_views(["prices"], [("cfg", _config_values_sql())], """
SELECT asset_name, asset_type FROM cfg WHERE asset_name NOT IN (SELECT DISTINCT asset_name FROM prices)"""))
def q_missing_assets(spark, sf):
    """Configured assets absent from the data."""
    return Q.missing_assets(asset_frame(spark, fx.FIXTURE_CONFIG), fx.prices(spark, sf))


@register("asset_filter", O.with_views(["prices"], [("cfg", _config_values_sql())], """
SELECT p.asset_name, c.asset_type, p.ts, p.tie, round(p.price, 4) AS price
FROM prices p JOIN cfg c ON c.asset_name = p.asset_name"""))
def q_asset_filter(spark, sf):
    """Rows of configured assets, typed from the configuration (broadcast dimension)."""
    p = fx.prices(spark, sf).drop("asset_type")
    return rounded(p.join(asset_frame(spark, fx.FIXTURE_CONFIG), "asset_name", "inner")
                   .select("asset_name", "asset_type", "ts", "tie", "price"))


@register("asset_dimension", O.with_views(["prices"], [("cfg", _config_values_sql())], """
SELECT c.asset_name, c.asset_type, coalesce(s.n_rows, 0) AS n_rows, s.first_ts, s.last_ts,
       s.n_rows IS NOT NULL AS present
FROM cfg c LEFT JOIN (SELECT asset_name, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
                      FROM prices GROUP BY 1) s ON s.asset_name = c.asset_name"""))
def q_asset_dimension(spark, sf):
    """Configured stocks ∪ cryptos with the data's per-asset extent."""
    stats = fx.prices(spark, sf).groupBy("asset_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    dim = asset_frame(spark, fx.FIXTURE_CONFIG)
    return dim.join(stats, "asset_name", "left").select(
        "asset_name", "asset_type", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "first_ts", "last_ts",
        F.col("n_rows").isNotNull().alias("present"))


# ------------------------------------------------------------- metrics ----
_METRIC_SQL = """
SELECT asset_name, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, avg(abs(y_true - y_pred)) AS mae,
       coalesce(avg(abs((y_true - y_pred) / y_true)) FILTER (WHERE y_true <> 0) * 100,
                CAST('Infinity' AS DOUBLE)) AS mape,
       CASE WHEN max(y_true) = min(y_true) THEN CAST('Infinity' AS DOUBLE)
            ELSE sqrt(avg((y_true - y_pred) * (y_true - y_pred))) / (max(y_true) - min(y_true)) END AS minmax_rmse,
       count(*) AS n
FROM preds GROUP BY 1"""
_DA_SQL = """
SELECT asset_name, coalesce(avg(CASE WHEN yp IS NOT NULL THEN CAST(sign(y_true - yp) = sign(y_pred - pp) AS DOUBLE) END)
                            * 100, 0) AS directional_accuracy
FROM (SELECT *, lag(y_true) OVER w AS yp, lag(y_pred) OVER w AS pp FROM preds
      WINDOW w AS (PARTITION BY asset_name ORDER BY ts, tie)) GROUP BY 1"""


@register("forecast_metrics", O.with_views(["preds"], [("m", _METRIC_SQL), ("da", _DA_SQL)], f"""
SELECT m.asset_name, {O.r('rmse')} AS rmse, {O.r('mae')} AS mae, {O.r('mape')} AS mape,
       {O.r('minmax_rmse')} AS minmax_rmse, {O.r('directional_accuracy')} AS directional_accuracy, n
FROM m JOIN da USING (asset_name)"""))
def q_forecast_metrics(spark, sf):
    """RMSE, MAE, MAPE, MinMax RMSE, directional accuracy per asset."""
    p = fx.preds(spark, sf).withColumn("_day", F.to_date("ts"))
    out = M.evaluate(p, ["asset_name"], "_day", ["ts", "tie"])
    return rounded(out.select("asset_name", "rmse", "mae", "mape", "minmax_rmse", "directional_accuracy", "n"))


@register("directional_accuracy", O.with_views(["preds"], [("da", _DA_SQL)],
                                               f"SELECT asset_name, {O.r('directional_accuracy')} AS directional_accuracy FROM da"))
def q_directional_accuracy(spark, sf):
    """Share of matching change directions per asset."""
    p = fx.preds(spark, sf).withColumn("_day", F.to_date("ts"))
    return rounded(M.directional_accuracy(p, ["asset_name"], "_day", ["ts", "tie"]))


# --------------------------------------------------------- exploration ----
def _features(spark, sf):
    return feature_table(fx.prices(spark, sf), FEATURES)


_FEAT = O.feature_ctes(FEATURES, FEATURE_COLS)


@register("asset_counts", O.with_views(["prices"], [], "SELECT asset_name, count(*) AS n_rows FROM prices GROUP BY 1"))
def q_asset_counts(spark, sf):
    """Rows per asset."""
    return X.rows_per_asset(fx.prices(spark, sf))


def _null_max_sql() -> str:
    ctes, name = O.indicator_select(FEATURES)
    cols = ["asset_name", "day", "asset_type", "close"] + [c for c in FEATURE_COLS if c != "close"]
    counts = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in cols)
    return O.with_views(["daily"], ctes, f"SELECT greatest({counts}) AS null_max FROM {name}", recursive=True)


@register("null_max", _null_max_sql())
def q_null_max(spark, sf):
    """The largest per-column null count of the indicator panel (warm-up rows kept)."""
    return X.null_profile(_panel(spark, sf))


@register("return_distribution", O.with_views(["daily"], _FEAT + [("qd", """
SELECT asset_name, quantile_cont(log_return, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q, avg(log_return) AS mean,
       stddev_samp(log_return) AS std, count(log_return) AS n FROM feat GROUP BY 1""")], f"""
SELECT asset_name, {O.r('q[1]')} AS p0, {O.r('q[2]')} AS p25, {O.r('q[3]')} AS p50, {O.r('q[4]')} AS p75,
       {O.r('q[5]')} AS p100, {O.r('mean')} AS mean, {O.r('std')} AS std, n FROM qd""", recursive=True))
def q_return_distribution(spark, sf):
    """Log-return quartiles, mean and std per asset."""
    return rounded(X.distribution(_features(spark, sf), "log_return"))


def _corr_sql() -> str:
    cols = FEATURE_COLS
    pairs = [(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if i > j]
    sel = ", ".join(f'corr("{a}", "{b}") AS "{a}|{b}"' for a, b in pairs)
    return O.with_views(["daily"], _FEAT + [("cm", f"SELECT {sel} FROM feat")], f"""
SELECT split_part(pair, '|', 1) AS col_a, split_part(pair, '|', 2) AS col_b, {O.r('corr')} AS corr
FROM (UNPIVOT cm ON COLUMNS(*) INTO NAME pair VALUE corr)""", recursive=True)


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, sf):
    """Pearson correlations of all numeric feature pairs below the diagonal."""
    f = _features(spark, sf)
    return rounded(X.correlation_pairs(f, X.numeric_columns(f)))


TAIL_N = 365


@register("tail_n", O.with_views(["prices"], [], f"""
SELECT asset_name, ts, tie, round(price, 4) AS price, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY ts DESC, tie DESC) AS rank FROM prices)
WHERE rank <= {TAIL_N}"""))
def q_tail_n(spark, sf):
    """The newest 365 raw rows per asset (top-k pushed below the shuffle)."""
    p = fx.prices(spark, sf).select("asset_name", "ts", "tie", "price")
    return rounded(X.tail_per_asset(p, TAIL_N, [F.col("ts"), F.col("tie")]))


@register("head_n", O.with_views(["prices"], [], f"""
SELECT asset_name, ts, tie, round(price, 4) AS price, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY ts, tie) AS rank FROM prices)
WHERE rank <= {TAIL_N}"""))
def q_head_n(spark, sf):
    """The oldest 365 raw rows per asset."""
    p = fx.prices(spark, sf).select("asset_name", "ts", "tie", "price")
    return rounded(X.tail_per_asset(p, TAIL_N, [F.col("ts"), F.col("tie")], newest_first=False))


# --------------------------------------------------------------- drift ----
_DRIFT_COLS = ["return", "log_return", "macd_diff", "rsi", "bb_width", "bb_position",
               f"volatility_{FEATURES.volatility_window}"]
_SPLIT_SQL = f"""
SELECT *, CASE WHEN n > 90 THEN (CASE WHEN rd > 30 THEN 'reference' ELSE 'current' END)
               ELSE (CASE WHEN n - rd + 1 <= floor(n * {O.dlit(0.66)}) THEN 'reference' ELSE 'current' END) END AS side
FROM (SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY day DESC) AS rd,
             count(*) OVER (PARTITION BY asset_name) AS n FROM feat) WHERE rd <= 90"""
_KS_SQL = """
SELECT asset_name, "column", max(abs(f_ref - f_cur)) AS ks_stat, CAST(any_value(n_ref) AS BIGINT) AS n_ref,
       CAST(any_value(n_cur) AS BIGINT) AS n_cur
FROM (SELECT asset_name, "column",
             sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) OVER w / sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) OVER g AS f_ref,
             sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) OVER w / sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) OVER g AS f_cur,
             sum(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) OVER g AS n_ref,
             sum(CASE WHEN side = 'current' THEN 1 ELSE 0 END) OVER g AS n_cur
      FROM (UNPIVOT (SELECT asset_name, side, %s FROM split) ON %s INTO NAME "column" VALUE value)
      WINDOW g AS (PARTITION BY asset_name, "column"),
             w AS (PARTITION BY asset_name, "column" ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
GROUP BY 1, 2""" % (", ".join(f'"{c}"' for c in _DRIFT_COLS), ", ".join(f'"{c}"' for c in _DRIFT_COLS))
_KSP_SQL = """
SELECT *, CASE WHEN lam < 0.2 THEN CAST(1 AS DOUBLE)
               ELSE least(greatest((SELECT sum(2 * (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END)
                                              * exp(-2 * k * k * lam * lam)) FROM range(1, 101) t(k)),
                                   CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) END AS p_value
FROM (SELECT *, sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * ks_stat AS lam FROM ks)"""


@register("drift_columns", O.with_views(["daily"], _FEAT, "SELECT asset_name, day, " + ", ".join(
    f'{O.r(chr(34) + c + chr(34))} AS "{c}"' for c in _DRIFT_COLS) + " FROM feat", recursive=True))
def q_drift_columns(spark, sf):
    """The feature table without keys and non-stationary columns."""
    f = _features(spark, sf)
    return rounded(f.select("asset_name", "day", *D.drift_columns(f)))


@register("drift_split", O.with_views(["daily"], _FEAT + [("split", _SPLIT_SQL)],
                                      "SELECT asset_name, day, side FROM split", recursive=True))
def q_drift_split(spark, sf):
    """Last 90 days per asset split 60/30 (or 0.66 of fewer) into reference/current."""
    return D.split_reference_current(_features(spark, sf)).select("asset_name", "day", "side")


def _ks(spark, sf, exact: bool = False):
    f = _features(spark, sf)
    return D.ks_statistics(D.split_reference_current(f), D.drift_columns(f), exact=exact)


@register("drift_ks", O.with_views(["daily"], _FEAT + [("split", _SPLIT_SQL), ("ks", _KS_SQL), ("ksp", _KSP_SQL)],
                                   f"""SELECT asset_name, "column", {O.r('ks_stat')} AS ks_stat, n_ref, n_cur,
       {O.r('p_value')} AS p_value, p_value < 0.05 AS drifted FROM ksp""", recursive=True))
def q_drift_ks(spark, sf):
    """Two-sample KS statistic, asymptotic p-value and drift flag per asset and column."""
    return rounded(_ks(spark, sf).select("asset_name", "column", "ks_stat", "n_ref", "n_cur", "p_value", "drifted"))


@register("drift_ks_exact")
def q_drift_ks_exact(spark, sf):
    """A21 with the exact small-sample p-value (lattice-path count) in place of the series."""
    return rounded(_ks(spark, sf, exact=True).select(
        "asset_name", "column", "ks_stat", "n_ref", "n_cur", "p_value", "drifted"))


@register("drift_summary", O.with_views(["daily"], _FEAT + [("split", _SPLIT_SQL), ("ks", _KS_SQL), ("ksp", _KSP_SQL)],
                                        """
SELECT asset_name, count(*) AS n_columns, count(*) FILTER (WHERE p_value < 0.05) AS n_drifted,
       round(CAST(count(*) FILTER (WHERE p_value < 0.05) AS DOUBLE) / count(*), 4) AS drift_share,
       CAST(count(*) FILTER (WHERE p_value < 0.05) AS DOUBLE) / count(*) >= 0.5 AS drift_detected,
       CASE WHEN CAST(count(*) FILTER (WHERE p_value < 0.05) AS DOUBLE) / count(*) >= 0.5
            THEN 'retrain_and_alert' ELSE 'none' END AS action
FROM ksp GROUP BY 1""", recursive=True))
def q_drift_summary(spark, sf):
    """Drifted share, flag and action per asset."""
    return rounded(D.drift_summary(_ks(spark, sf)))


@register("drift_report", O.with_views(["daily"], _FEAT + [("split", _SPLIT_SQL), ("ks", _KS_SQL), ("ksp", _KSP_SQL)], f"""
SELECT asset_name, lower(translate(asset_name, '. ', '__')) AS report_name, "column" AS column_name,
       {O.r('ks_stat')} AS ks_stat, {O.r('p_value')} AS p_value, p_value < 0.05 AS drifted,
       count(*) FILTER (WHERE p_value < 0.05) OVER (PARTITION BY asset_name) AS n_drifted
FROM ksp""", recursive=True))
def q_drift_report(spark, sf):
    """One nested drift report per asset as JSON, read back and flattened."""
    from barline.session import materialize

    ks = materialize(_ks(spark, sf), "drift-ks")
    report = D.drift_report(ks, D.drift_summary(ks))
    path = scratch_path(spark, "drift-report")
    FI.write_json(report, path)
    back = spark.read.schema(report.schema).json(path)
    flat = back.select("asset_name", "report_name", "n_drifted", F.explode("columns").alias("c"))
    return rounded(flat.select("asset_name", "report_name", F.col("c.column").alias("column_name"), "c.ks_stat",
                               "c.p_value", "c.drifted", "n_drifted"))


# ----------------------------------------------------------- sequences ----
from barline.operators import registry as R  # noqa: E402
from barline.operators import scoring as S  # noqa: E402
from barline.operators import sequences as SQ  # noqa: E402
from barline.functions import names as NM  # noqa: E402

LOOK_BACK = fx.FIXTURE_CONFIG.lookback.look_back


def _scaled(spark, sf):
    f = SQ.minmax_fit(_features(spark, sf))
    return f.withColumn("scaled", SQ.scale(F.col("close"), F.col("x_min"), F.col("x_max")))


_SCALED_SQL = """
SELECT *, CASE WHEN x_max = x_min THEN CAST(0 AS DOUBLE) ELSE (close - x_min) / (x_max - x_min) END AS scaled
FROM (SELECT *, min(close) OVER (PARTITION BY asset_name) AS x_min, max(close) OVER (PARTITION BY asset_name) AS x_max
      FROM feat)"""
_SEQ_SQL = f"""
SELECT *, CAST(rn - {LOOK_BACK} AS INTEGER) AS seq_idx FROM (
  SELECT *, row_number() OVER w AS rn, [{', '.join(f'lag(scaled, {k}) OVER w' for k in range(LOOK_BACK, 0, -1))}] AS seq
  FROM scaled WINDOW w AS (PARTITION BY asset_name ORDER BY day)) WHERE rn > {LOOK_BACK}"""
_SPLIT3_SQL = f"""
SELECT *, CASE WHEN seq_idx <= floor(n * {O.dlit(0.6)}) THEN 'train'
               WHEN seq_idx <= floor(n * {O.dlit(0.6 + 0.2)}) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, count(*) OVER (PARTITION BY asset_name) AS n FROM seqs)
WHERE n >= 5 AND floor(n * {O.dlit(0.6)}) >= 1 AND floor(n * {O.dlit(0.6 + 0.2)}) > floor(n * {O.dlit(0.6)})
  AND n > floor(n * {O.dlit(0.6 + 0.2)})"""
_SEQ_CTES = _FEAT + [("scaled", _SCALED_SQL), ("seqs", _SEQ_SQL), ("splits", _SPLIT3_SQL)]


@register("minmax_scale", O.with_views(["daily"], _SEQ_CTES[:len(_FEAT) + 1], f"""
SELECT asset_name, day, round(close, 4) AS close, round(x_min, 4) AS x_min, round(x_max, 4) AS x_max,
       {O.r('scaled')} AS scaled, {O.r('scaled * (x_max - x_min) + x_min')} AS restored FROM scaled""", recursive=True))
def q_minmax_scale(spark, sf):
    """Per-asset min-max scaling of close and its inverse."""
    s = _scaled(spark, sf)
    return rounded(s.select("asset_name", "day", "close", "x_min", "x_max", "scaled",
                            SQ.unscale(F.col("scaled"), F.col("x_min"), F.col("x_max")).alias("restored")))


def _seqs(spark, sf):
    return SQ.lookback(_scaled(spark, sf), LOOK_BACK)


@register("lookback_sequences", O.with_views(["daily"], _SEQ_CTES[:len(_FEAT) + 2], f"""
SELECT asset_name, day, seq_idx, CAST(unnest(range(0, {LOOK_BACK})) AS INTEGER) AS pos,
       round(unnest(seq), 4) AS x, round(scaled, 4) AS y FROM seqs""", recursive=True))
def q_lookback_sequences(spark, sf):
    """Look-back windows of scaled close (flattened: one row per element) and their label."""
    s = _seqs(spark, sf)
    flat = s.select("asset_name", "day", "seq_idx", F.posexplode("seq").alias("pos", "x"), F.col("scaled").alias("y"))
    return rounded(flat)


@register("sequence_align", O.with_views(["daily"], _SEQ_CTES[:len(_FEAT) + 2], """
SELECT asset_name, day, seq_idx, round(close, 4) AS close, round(target, 4) AS target FROM seqs""", recursive=True))
def q_sequence_align(spark, sf):
    """Feature rows aligned to sequences (first look_back rows dropped)."""
    return rounded(_seqs(spark, sf).select("asset_name", "day", "seq_idx", "close", "target"))


@register("chrono_split", O.with_views(["daily"], _SEQ_CTES,
                                       "SELECT asset_name, day, seq_idx, split FROM splits", recursive=True))
def q_chrono_split(spark, sf):
    """Chronological 60/20/20 split of each asset's sequences."""
    return SQ.chrono_split(_seqs(spark, sf)).select("asset_name", "day", "seq_idx", "split")


_SPLIT80_SQL = f"""
SELECT *, CASE WHEN seq_idx <= floor(n * {O.dlit(0.8)}) THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, count(*) OVER (PARTITION BY asset_name) AS n FROM seqs)
WHERE n >= 2 AND floor(n * {O.dlit(0.8)}) >= 1 AND n > floor(n * {O.dlit(0.8)})"""


@register("search_split", O.with_views(["daily"], _SEQ_CTES[:len(_FEAT) + 2] + [("split80", _SPLIT80_SQL)],
                                       "SELECT asset_name, day, seq_idx, split FROM split80", recursive=True))
def q_search_split(spark, sf):
    """Chronological 80/20 split of each asset's sequences, as the search uses it."""
    return SQ.chrono_split(_seqs(spark, sf), (0.8,), min_rows=2).select("asset_name", "day", "seq_idx", "split")


# ------------------------------------------------------------ registry ----
_LATEST_SQL = """
SELECT model_name, run_id, rmse, mae FROM (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY start_time DESC, run_id DESC) AS rk
                 FROM runs WHERE status = 'FINISHED') WHERE rk <= 10 AND rmse IS NOT NULL)
QUALIFY rk = min(rk) OVER (PARTITION BY model_name)"""


@register("latest_run_metrics", O.with_views(["runs"], [("latest", _LATEST_SQL)],
                                             "SELECT model_name, run_id, round(rmse, 4) AS rmse, round(mae, 4) AS mae FROM latest"))
def q_latest_run_metrics(spark, sf):
    """Per model, newest finished run (of the last 10) that has an RMSE."""
    return rounded(R.latest_run_metrics(fx.runs(spark, sf)))


@register("perf_threshold", O.with_views(["runs"], [("latest", _LATEST_SQL)], f"""
SELECT model_name, run_id, round(rmse, 4) AS rmse, round(mae, 4) AS mae,
       NOT coalesce(rmse > {O.dlit(R.RMSE_LIMIT)}, false) AS rmse_ok,
       NOT coalesce(mae > {O.dlit(R.MAE_LIMIT)}, false) AS mae_ok,
       NOT coalesce(rmse > {O.dlit(R.RMSE_LIMIT)}, false) AND NOT coalesce(mae > {O.dlit(R.MAE_LIMIT)}, false) AS healthy
FROM latest"""))
def q_perf_threshold(spark, sf):
    """Health verdict of each model's latest metrics (rmse 20000, mae 15000)."""
    return rounded(R.threshold_check(R.latest_run_metrics(fx.runs(spark, sf))))


@register("run_metrics_view", O.with_views(["runs"], [("newest", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY start_time DESC, run_id DESC) AS rk
               FROM runs WHERE status = 'FINISHED') WHERE rk = 1""")], """
SELECT model_name, run_id, metric, round(value, 4) AS value, 'available' AS status
FROM (UNPIVOT (SELECT model_name, run_id, rmse, mae FROM newest) ON rmse, mae INTO NAME metric VALUE value)
WHERE value IS NOT NULL
UNION ALL
SELECT model_name, run_id, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), 'available' FROM newest WHERE rmse IS NULL AND mae IS NULL
UNION ALL
SELECT DISTINCT model_name, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), 'unavailable'
FROM runs WHERE model_name NOT IN (SELECT model_name FROM newest)"""))
def q_run_metrics_view(spark, sf):
    """Metric rows of each model's newest finished run; 'unavailable' when none."""
    return rounded(R.run_metrics_view(fx.runs(spark, sf), ["rmse", "mae"]))


_PROMO_CTES = [
    ("newest_v", """
  SELECT model_name, arg_max(version, CAST(version AS BIGINT)) AS newest_version,
         arg_max(run_id, CAST(version AS BIGINT)) AS newest_run_id FROM versions GROUP BY 1"""),
    ("champ", """
  SELECT a.model_name, a.version AS champion_version, v.run_id AS champion_run_id
  FROM aliases a LEFT JOIN versions v ON v.model_name = a.model_name AND v.version = a.version
  WHERE a.alias = 'Champion'"""),
    ("plan", """
  SELECT n.*, c.champion_version, c.champion_run_id, rn.rmse AS new_metric, rc.rmse AS champion_metric
  FROM newest_v n LEFT JOIN champ c USING (model_name)
  LEFT JOIN runs rn ON rn.run_id = n.newest_run_id LEFT JOIN runs rc ON rc.run_id = c.champion_run_id"""),
    ("decided", """
  SELECT *, CASE WHEN champion_version IS NULL THEN 'promote'
                 WHEN newest_version = champion_version THEN 'keep'
                 WHEN new_metric IS NULL OR champion_metric IS NULL THEN 'skip'
                 WHEN new_metric < champion_metric THEN 'promote' ELSE 'keep' END AS action FROM plan"""),
]


@register("champion_promotion", O.with_views(["runs", "versions", "aliases"], _PROMO_CTES, """
SELECT model_name, newest_version, champion_version, round(new_metric, 4) AS new_metric,
       round(champion_metric, 4) AS champion_metric, action,
       CASE WHEN action = 'promote' THEN newest_version ELSE champion_version END AS champion_after
FROM decided"""))
def q_champion_promotion(spark, sf):
    """Promotion decision per model (strictly better RMSE wins)."""
    v = fx.versions(spark, sf)
    return rounded(R.promotion_plan(fx.runs(spark, sf), v, fx.aliases(spark, sf, v)))


def _configured_models(spark):
    a = asset_frame(spark, fx.FIXTURE_CONFIG)
    return a.select("asset_name", F.concat(F.lit("m_"), F.col("asset_name")).alias("model_name"))


@register("champion_check", O.with_views(["versions", "aliases"], [("cfg", _config_values_sql())], """
SELECT c.asset_name, 'm_' || c.asset_name AS model_name, a.version AS champion_version, v.run_id AS champion_run_id,
       CASE WHEN a.version IS NULL THEN 'none' ELSE 'ok' END AS status
FROM cfg c LEFT JOIN aliases a ON a.model_name = 'm_' || c.asset_name AND a.alias = 'Champion'
LEFT JOIN versions v ON v.model_name = a.model_name AND v.version = a.version"""))
def q_champion_check(spark, sf):
    """Champion version per configured asset ('none' when absent)."""
    v = fx.versions(spark, sf)
    out = R.champion_status(_configured_models(spark), fx.aliases(spark, sf, v), v)
    return out.select("asset_name", "model_name", "champion_version", "champion_run_id", "status")


@register("registry_listing", O.with_views(["versions", "aliases"], [], """
SELECT v.model_name, v.version, v.run_id, coalesce(t.aliases, '') AS aliases
FROM versions v LEFT JOIN (SELECT model_name, version, array_to_string(list_sort(list_distinct(list(alias))), ',') AS aliases
                           FROM aliases GROUP BY 1, 2) t
  ON t.model_name = v.model_name AND t.version = v.version
WHERE starts_with(v.model_name, 'm_')"""))
def q_registry_listing(spark, sf):
    """Versions of the models with the registry prefix and their aliases."""
    v = fx.versions(spark, sf)
    return R.registry_listing(v, fx.aliases(spark, sf, v), "m_")


@register("model_info", O.with_views(["versions", "aliases"], [("cfg", _config_values_sql()), ("mi", f"""
SELECT c.asset_name, a.model_name IS NOT NULL AS model_loaded,
       'workspace.default.' || lower(translate('{NM.MODEL_PREFIX}' || translate(c.asset_name, '{NM.ARTIFACT_CHARS.replace("'", "''")}', '________'), '. ', '__')) AS registry_name
FROM cfg c LEFT JOIN (SELECT DISTINCT model_name FROM aliases WHERE alias = 'Champion') a
  ON a.model_name = 'm_' || c.asset_name""")], """
SELECT *, count(*) FILTER (WHERE model_loaded) OVER () AS total_loaded FROM mi"""))
def q_model_info(spark, sf):
    """Configured assets, load state (champion present) and registry names."""
    loaded = fx.aliases(spark, sf).where(F.col("alias") == R.CHAMPION).select(
        F.expr("substring(model_name, 3)").alias("asset_name"))
    return R.model_info(asset_frame(spark, fx.FIXTURE_CONFIG), loaded)


@register("model_names", O.with_views(["prices", "crypto_bars"], [("names", """
SELECT DISTINCT asset_name FROM prices UNION SELECT DISTINCT asset_name FROM crypto_bars""")], f"""
SELECT asset_name,
       translate(asset_name, '{NM.ARTIFACT_CHARS.replace("'", "''")}', '________') AS artifact_name,
       '{NM.MODEL_PREFIX}' || translate(asset_name, '{NM.ARTIFACT_CHARS.replace("'", "''")}', '________') AS model_name,
       'workspace.default.' || lower(translate('{NM.MODEL_PREFIX}' || translate(asset_name, '{NM.ARTIFACT_CHARS.replace("'", "''")}', '________'), '. ', '__')) AS registry_name,
       lower(translate(asset_name, '. ', '__')) AS report_name
FROM names"""))
def q_model_names(spark, sf):
    """Artifact, model, registry and report names of every asset in the data."""
    names = fx.prices(spark, sf).select("asset_name").distinct().unionByName(
        fx.crypto_bars(spark, sf).select("asset_name").distinct()).distinct()
    a = F.col("asset_name")
    return names.select(
        "asset_name", NM.artifact_name_col(a).alias("artifact_name"), NM.model_base_col(a).alias("model_name"),
        NM.registry_name_col(NM.model_base_col(a)).alias("registry_name"), NM.report_name_col(a).alias("report_name"))


# ------------------------------------------------------------- scoring ----
SERVED_ASSETS = ("known",)  # serving table of the request fixture


def _served(spark):
    return spark.createDataFrame([(a,) for a in SERVED_ASSETS], "asset_name string")


_EVENT_KEYS = ("click", "error", "purchase", "signup", "view")


def _requests(spark, sf):
    return S.parse_payloads(fx.requests(spark, sf))


@register("requests_explode", O.with_views(["requests_flat"], [], f"""
SELECT request_id, asset_name, CAST(row_number() OVER (PARTITION BY request_id ORDER BY ts, event_id) - 1 AS INTEGER) AS pos,
       {', '.join(f"CASE WHEN event_type = '{k}' THEN CAST(1 AS DOUBLE) END AS {k}" for k in _EVENT_KEYS)},
       round(close, 4) AS close, k, NULL AS payload_error FROM requests_flat
UNION ALL
SELECT request_id, asset_name, NULL, {', '.join('NULL' for _ in _EVENT_KEYS)}, NULL, NULL, '{S.BAD_PAYLOAD}' FROM request_users WHERE bad"""))
def q_requests_explode(spark, sf):
    """Request payloads (JSON lists of differing objects) → one row per object over the union of their keys."""
    return rounded(S.explode_requests(_requests(spark, sf)))


_ROUTE_SQL = f"""
SELECT u.request_id, u.asset_name, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows,
       CASE WHEN u.bad THEN '{S.BAD_PAYLOAD}'
            WHEN u.asset_name NOT IN ({', '.join(f"'{a}'" for a in SERVED_ASSETS)}) THEN 'Model for ''' || u.asset_name || ''' not available'
            WHEN coalesce(c.n, 0) = 0 THEN 'Features list cannot be empty'
            WHEN coalesce(c.n, 0) < {LOOK_BACK} THEN 'Validation error: Input data must contain at least {LOOK_BACK} rows for LSTM context.'
       END AS error
FROM request_users u LEFT JOIN (SELECT request_id, count(*) AS n FROM requests_flat GROUP BY 1) c USING (request_id)"""


@register("batch_predict", O.with_views(["requests_flat", "request_users"], [("routed", _ROUTE_SQL)], """
SELECT request_id, asset_name, n_rows, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status, error
FROM routed"""))
def q_batch_predict(spark, sf):
    """Per-request routing — readable payload, model lookup, empty payload, too few rows."""
    r = S.route_requests(_requests(spark, sf), _served(spark), LOOK_BACK)
    return r.withColumn("n_rows", F.col("n_rows").cast("long"))


@register("batch_predict_summary", O.with_views(["requests_flat", "request_users"], [("routed", _ROUTE_SQL)], """
SELECT count(*) AS total_requests, count(*) FILTER (WHERE error IS NULL) AS successful,
       count(*) FILTER (WHERE error IS NOT NULL) AS failed FROM routed"""))
def q_batch_predict_summary(spark, sf):
    """Batch metadata — total, successful, failed."""
    return S.batch_summary(S.route_requests(_requests(spark, sf), _served(spark), LOOK_BACK))


# ---------------------------------------------------------- model jobs ----
from barline.operators import model_store as MS  # noqa: E402
from barline.operators import models as MD  # noqa: E402
from barline.plans import training as TR  # noqa: E402

CFG = fx.FIXTURE_CONFIG


def _l1(spark, sf):
    return TR.stage1(_features(spark, sf), CFG, look_back=1, ridge=0.0)


_L1_CTES = _FEAT + [("scaled", _SCALED_SQL), ("seqs1", """
SELECT *, rn - 1 AS seq_idx FROM (
  SELECT *, row_number() OVER w AS rn, lag(scaled, 1) OVER w AS x FROM scaled
  WINDOW w AS (PARTITION BY asset_name ORDER BY day)) WHERE rn > 1"""), ("split1", f"""
SELECT *, CASE WHEN seq_idx <= floor(n * {O.dlit(0.6)}) THEN 'train'
               WHEN seq_idx <= floor(n * {O.dlit(0.6 + 0.2)}) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, count(*) OVER (PARTITION BY asset_name) AS n FROM seqs1)
WHERE n >= 5 AND floor(n * {O.dlit(0.6)}) >= 1 AND floor(n * {O.dlit(0.6 + 0.2)}) > floor(n * {O.dlit(0.6)})
  AND n > floor(n * {O.dlit(0.6 + 0.2)})"""), ("fit1", """
SELECT asset_name, regr_slope(scaled, x) AS slope, regr_intercept(scaled, x) AS intercept, count(*) AS n_train
FROM split1 WHERE split = 'train' GROUP BY 1""")]


@register("lookback_fit_l1", O.with_views(["daily"], _L1_CTES, f"""
SELECT asset_name, {O.r('slope', 6)} AS slope, {O.r('intercept', 6)} AS intercept, n_train FROM fit1""", recursive=True))
def q_lookback_fit_l1(spark, sf):
    """M1 (L=1, no penalty): per-asset least-squares next-value model on the train part."""
    w = _l1(spark, sf).weights
    return w.select("asset_name", F.round(F.col("weights")[1], 6).alias("slope"),
                    F.round(F.col("weights")[0], 6).alias("intercept"), F.col("n").alias("n_train"))


@register("next_forecast_l1", O.with_views(["daily"], _L1_CTES + [("last1", """
SELECT * FROM scaled QUALIFY row_number() OVER (PARTITION BY asset_name ORDER BY day DESC) = 1""")], f"""
SELECT l.asset_name, l.day AS last_date, round(l.close, 4) AS current_price,
       {O.r('(f.intercept + f.slope * l.scaled) * (l.x_max - l.x_min) + l.x_min')} AS forecast_price,
       {O.r('((f.intercept + f.slope * l.scaled) * (l.x_max - l.x_min) + l.x_min - l.close) / l.close * 100')}
         AS predicted_change_pct
FROM last1 l JOIN fit1 f USING (asset_name)""", recursive=True))
def q_next_forecast_l1(spark, sf):
    """M6 (naive stage-1 forecast, L=1): next-day forecast record per asset."""
    s1 = _l1(spark, sf)
    live = TR.live_rows(s1, 1)
    return rounded(TR.forecast_records(live, forecast="lstm_pred"))


@register("lookback_fit")
def q_lookback_fit(spark, sf):
    """M1: per-asset ridge look-back regressor (L from config) — weights and train size."""
    s1 = TR.stage1(_features(spark, sf), CFG)
    return s1.weights.select("asset_name", F.transform("weights", lambda v: F.round(v, 6)).alias("weights"),
                             F.col("n").alias("n_train"))


@register("stack_features")
def q_stack_features(spark, sf):
    """val/test feature rows with the un-scaled stage-1 prediction attached."""
    s1 = TR.stage1(_features(spark, sf), CFG)
    st = TR.with_stage1_pred(s1.seqs.where(F.col("split") != "train"), s1.weights, CFG.lookback.look_back)
    return rounded(st.select("asset_name", "day", "split", *TR.stack_features(st)))


@register("stack_features_l1", O.with_views(["daily"], _L1_CTES, f"""
SELECT s.asset_name, s.day, s.split, {O.r('(f.intercept + f.slope * s.x) * (s.x_max - s.x_min) + s.x_min')} AS lstm_pred
FROM split1 s JOIN fit1 f USING (asset_name) WHERE s.split <> 'train'""", recursive=True))
def q_stack_features_l1(spark, sf):
    """J1 with L=1 and no penalty: the un-scaled stage-1 prediction of every val/test row."""
    s1 = _l1(spark, sf)
    st = TR.with_stage1_pred(s1.seqs.where(F.col("split") != "train"), s1.weights, 1)
    return rounded(st.select("asset_name", "day", "split", "lstm_pred"))


_TRAINED: dict = {}
_SEARCHED: dict = {}


def _trained(spark, sf):
    """Train once per (application, data folder); scoring keys reuse the fitted stages."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = TR.train_stacked(_features(spark, sf), CFG)
    return _TRAINED[key]


def _searched(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SEARCHED:
        _SEARCHED[key] = TR.hyperparam_search(_features(spark, sf), CFG)
    return _SEARCHED[key]


@register("stacked_fit")
def q_stacked_fit(spark, sf):
    """Stage 2 trained on val, metrics on test per asset."""
    _, stacked, cols, models = _trained(spark, sf)
    return rounded(TR.test_metrics(stacked, cols, models))


@register("batch_score")
def q_batch_score(spark, sf):
    """M4: batch scoring with lstm_pred supplied (close dropped) on the test rows."""
    _, stacked, cols, models = _trained(spark, sf)
    test = stacked.where(F.col("split") == "test").select("asset_name", "day", *cols)
    return rounded(TR.B.predict_boost(test, cols, models).select("asset_name", "day", "prediction"))


@register("live_score")
def q_live_score(spark, sf):
    """M5: live scoring of each asset's newest row (last L closes → stage 1 → stage 2)."""
    s1, _, cols, models = _trained(spark, sf)
    live = TR.live_rows(s1, CFG.lookback.look_back).select("asset_name", "day", "close", *cols)
    return rounded(TR.B.predict_boost(live, cols, models).select("asset_name", "day", "close", "lstm_pred", "prediction"))


@register("next_forecast")
def q_next_forecast(spark, sf):
    """M6: next-day forecast record per asset from the two-stage model."""
    s1, _, cols, models = _trained(spark, sf)
    live = TR.live_rows(s1, CFG.lookback.look_back).select("asset_name", "day", "close", *cols)
    return rounded(TR.forecast_records(TR.B.predict_boost(live, cols, models)))


@register("model_store")
def q_model_store(spark, sf):
    """Save both stages, load them back, score the test rows with the loaded models."""
    s1, stacked, cols, models = _trained(spark, sf)
    root = TR.save_models(spark, s1.weights, models, "fixture")
    weights, loaded = TR.load_models(spark, root)
    test = stacked.where(F.col("split") == "test").drop("lstm_pred", "weights")
    test = TR.with_stage1_pred(test, weights, CFG.lookback.look_back).select("asset_name", "day", *cols)
    return rounded(TR.B.predict_boost(test, cols, loaded).select("asset_name", "day", "lstm_pred", "prediction"))


@register("champion_scores", O.with_views(["daily"], _L1_CTES + [("verfit", """
SELECT asset_name, v, regr_slope(scaled, x) AS slope, regr_intercept(scaled, x) AS intercept
FROM split1, (VALUES ('1'), ('2'), ('3')) t(v) WHERE split = 'train' OR (split = 'val' AND v >= '2') OR v = '3'
GROUP BY 1, 2"""), ("champion", """
SELECT asset_name, CASE left(asset_name, 1) WHEN '1' THEN '2' WHEN '2' THEN '3' WHEN '3' THEN '1' WHEN '4' THEN '9' END AS version
FROM (SELECT DISTINCT asset_name FROM scaled)"""), ("last1", """
SELECT * FROM scaled QUALIFY row_number() OVER (PARTITION BY asset_name ORDER BY day DESC) = 1""")], f"""
SELECT l.asset_name, c.version, CASE WHEN c.version IS NULL THEN 'no alias' WHEN f.v IS NULL THEN 'version not stored' END AS failure,
       round(l.close, 4) AS current_price,
       {O.r('(f.intercept + f.slope * l.scaled) * (l.x_max - l.x_min) + l.x_min')} AS forecast_price
FROM last1 l JOIN champion c USING (asset_name) LEFT JOIN verfit f ON f.asset_name = l.asset_name AND f.v = c.version""", recursive=True))
def q_champion_scores(spark, sf):
    """S10 (L=1): three versions of every asset's model stored, the champions loaded by alias, live rows scored with them.

    Version 1 is fitted on the first 60 % of an asset's days, 2 on 80 %, 3 on all.
    Aliases name versions 2, 3 and 1, one that is not stored, and none for the fifth asset.
    """
    s1 = _l1(spark, sf)
    parts = F.when(F.col("split") == "train", F.array(*map(F.lit, "123"))).when(
        F.col("split") == "val", F.array(*map(F.lit, "23"))).otherwise(F.array(F.lit("3")))
    seqs = s1.seqs.withColumn("version", F.explode(parts)).withColumn("_fit", F.concat("version", F.lit("@"), "asset_name"))
    fits = MD.fit_lookback(seqs, 1, 0.0, "_fit").select(
        F.substring_index("_fit", "@", 1).alias("version"), F.expr("substring(_fit, instr(_fit, '@') + 1)").alias("asset_name"),
        "weights", "n")
    scaler = s1.scaled.groupBy("asset_name").agg(F.first("x_min").alias("x_min"), F.first("x_max").alias("x_max"))
    name = NM.registry_name_col(NM.model_base_col(F.col("asset_name"))).alias("model_name")
    root = scratch_path(spark, "model-versions")
    MS.save_versions(fits.join(scaler, "asset_name").select("*", name), root)

    assets = scaler.select("asset_name", name)
    first = F.substring("asset_name", 1, 1)
    version = F.when(first == "1", "2").when(first == "2", "3").when(first == "3", "1").when(first == "4", "9")
    aliases = materialize(assets.select("model_name", F.lit("Champion").alias("alias"), version.alias("version")).where(
        F.col("version").isNotNull()), "aliases")
    loaded = MS.load_by_alias(assets, aliases, MS.stored_versions(spark, root))
    live = MD.last_row(SQ.lookback(s1.scaled, 1, include_current=True)).select("asset_name", "close", "seq", name)
    pred = SQ.unscale(MD.lookback_predict(F.col("seq"), F.col("weights"), 1), F.col("x_min"), F.col("x_max"))
    return rounded(live.join(loaded.drop("asset_name"), "model_name", "left").select(
        "asset_name", "version", "failure", F.col("close").alias("current_price"), pred.alias("forecast_price")))


@register("hyperparam_search")
def q_hyperparam_search(spark, sf):
    """M7: seeded random search over the tuned parameters, RMSE on the last 20 %."""
    return rounded(_searched(spark, sf))


@register("param_override")
def q_param_override(spark, sf):
    """Best trial written as JSON, read back, applied over the configuration defaults."""
    path = scratch_path(spark, "best-params")
    TR.save_best_params(_searched(spark, sf), path)
    return TR.effective_params(TR.load_best_params(spark, path), CFG)


# ----------------------------------------------------------- streaming ----
from barline.session import scratch_path  # noqa: E402
from barline.streaming import daily_close as SD  # noqa: E402
from barline.streaming import live_score as SL  # noqa: E402


@register("stream_daily_close", f"""
SELECT event_type AS asset_name, CAST(ts AS DATE) AS day, {O.r('arg_max(value, row(ts, event_id))')} AS close
FROM events GROUP BY 1, 2""")
def q_stream_daily_close(spark, sf):
    """T-1: events file stream → watermarked 1-day windows → last value per type and day."""
    return rounded(SD.events_daily_close(spark, sf))


FEED_SCHEMA = T.StructType([
    T.StructField("asset_name", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("close", T.DoubleType()),
])


def _stream_scores(spark, sf, look_back: int, ridge: float):
    """Daily closes arriving as two loads of files, scored live; the look-back model is fitted on the first 80 % of days."""
    daily = _daily(spark, sf).select("asset_name", "day", "close")
    feed = scratch_path(spark, "feed-daily-close")
    daily.write.mode("overwrite").parquet(feed + "-all")
    daily = spark.read.schema(FEED_SCHEMA).parquet(feed + "-all")
    # the cut day is a scalar subquery (one aggregate, no join)
    cut = daily.agg(F.expr("date_add(min(day), CAST(datediff(max(day), min(day)) * 0.8 AS INT))")).scalar()
    daily.where(F.col("day") <= cut).write.mode("append").parquet(feed)
    daily.where(F.col("day") > cut).write.mode("append").parquet(feed)
    h = SQ.minmax_fit(daily.where(F.col("day") <= cut))
    h = h.withColumn("scaled", SQ.scale(F.col("close"), F.col("x_min"), F.col("x_max")))
    seqs = SQ.lookback(h, look_back).withColumn("y", F.col("scaled"))
    weights = MD.fit_lookback(seqs, look_back, ridge)
    scaler = h.groupBy("asset_name").agg(F.first("x_min").alias("x_min"), F.first("x_max").alias("x_max"))
    stream = SD.file_stream(spark, feed, FEED_SCHEMA)
    sink = SD.run_to_table(spark, SL.live_scores(stream, scaler.join(weights, "asset_name"), look_back), "live-score")
    return rounded(SL.newest_scores(sink))


@register("stream_live_score")
def q_stream_live_score(spark, sf):
    """T-2: every daily close of the feed with its forecast, from per-asset state."""
    return _stream_scores(spark, sf, CFG.lookback.look_back, CFG.lookback.ridge)


@register("stream_live_score_l1", O.with_views(["daily"], [("cut", """
SELECT min(day) + CAST(floor(date_diff('day', min(day), max(day)) * 0.8) AS INTEGER) AS cut FROM daily"""), ("hist", """
SELECT asset_name, day, (close - x_min) / (x_max - x_min) AS scaled, x_min, x_max FROM (
  SELECT asset_name, day, close, min(close) OVER (PARTITION BY asset_name) AS x_min,
         max(close) OVER (PARTITION BY asset_name) AS x_max FROM daily, cut WHERE day <= cut)"""), ("fit", """
SELECT asset_name, any_value(x_min) AS x_min, any_value(x_max) AS x_max, regr_slope(scaled, x) AS slope,
       regr_intercept(scaled, x) AS intercept
FROM (SELECT *, lag(scaled) OVER (PARTITION BY asset_name ORDER BY day) AS x FROM hist) GROUP BY 1""")], f"""
SELECT asset_name, day, round(close, 4) AS close,
       {O.r('(intercept + slope * (close - x_min) / (x_max - x_min)) * (x_max - x_min) + x_min')} AS forecast
FROM daily JOIN fit USING (asset_name)""", recursive=True))
def q_stream_live_score_l1(spark, sf):
    """T-2 with one look-back close and no penalty."""
    return _stream_scores(spark, sf, 1, 0.0)


# ---------------------------------------------------------- file io ------
from barline.sources import files as FI  # noqa: E402


@register("csv_roundtrip", _feature_sql())
def q_csv_roundtrip(spark, sf):
    """Feature table → CSV per asset → read back with an explicit schema."""
    ft = feature_table(fx.prices(spark, sf), FEATURES)
    path = scratch_path(spark, "features-csv")
    FI.write_csv(ft, path)
    schema = T.StructType([f for f in ft.schema.fields if f.name != "asset_name"]
                          + [T.StructField("asset_name", T.StringType())])
    back = FI.read_csv(spark, path, schema)
    return rounded(back.select(*ft.columns))


# the serving table of the request fixture: serving name → trained asset
SERVED_MODELS = {"known": "1-URGENT"}


@register("batch_predict_values")
def q_batch_predict_values(spark, sf):
    """M8: per-request routing plus stage-1 forecasts from each request's last L closes."""
    s1 = TR.stage1(_features(spark, sf), CFG)
    scaler = s1.scaled.groupBy("asset_name").agg(F.first("x_min").alias("x_min"), F.first("x_max").alias("x_max"))
    fitted = scaler.join(s1.weights, "asset_name")
    mapping = spark.createDataFrame(list(SERVED_MODELS.items()), "serving_name string, asset_name string")
    models = mapping.join(fitted, "asset_name").select(
        F.col("serving_name").alias("asset_name"), "x_min", "x_max", "weights")
    out = S.score_requests(_requests(spark, sf), models, LOOK_BACK)
    return rounded(out.withColumn("n_rows", F.col("n_rows").cast("long")))


_LINES_SQL = """
SELECT o_orderkey AS k, o_orderdate AS d, CAST(o_totalprice AS DECIMAL(18, 2)) AS p,
       concat(o_orderkey, ',', o_orderpriority, ',',
              CASE WHEN o_orderkey % 29 = 0 THEN 'yesterday' ELSE strftime(o_orderdate, '%Y-%m-%d 00:00:00') END,
              CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN ',n/a' WHEN o_orderkey % 13 = 0 THEN ','
                   ELSE concat(',', CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)) END,
              CASE WHEN o_orderkey % 31 = 0 THEN ',extra' ELSE '' END) AS line,
       o_orderkey % 29 = 0 OR o_orderkey % 17 = 0 AND o_orderkey % 23 <> 0 OR o_orderkey % 31 = 0 AND o_orderkey % 23 <> 0
         OR o_orderkey % 23 = 0 AS rejected, o_orderpriority AS a
FROM orders"""


@register("csv_rejects", f"""
WITH lines AS ({_LINES_SQL})
SELECT rejected, CASE WHEN rejected THEN line END AS line, CASE WHEN NOT rejected THEN k END AS order_key,
       CASE WHEN NOT rejected THEN a END AS asset_name, CASE WHEN NOT rejected THEN CAST(d AS TIMESTAMP) END AS ts,
       CASE WHEN NOT rejected AND k % 13 <> 0 THEN CAST(p AS DOUBLE) END AS price
FROM lines""")
def q_csv_rejects(spark, sf):
    """All orders as CSV lines, some broken; the good ones as typed rows with a timestamp, the others as rejected lines.

    Broken: a time or price that is no such value, a missing or an additional field.
    An empty price is null.
    """
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    key = F.col("o_orderkey")
    price = F.when(key % 23 == 0, "").when(key % 17 == 0, ",n/a").when(key % 13 == 0, ",").otherwise(
        F.concat(F.lit(","), F.col("o_totalprice").cast("decimal(18,2)").cast("string")))
    time = F.when(key % 29 == 0, "yesterday").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00"))
    line = F.concat(key.cast("string"), F.lit(","), F.col("o_orderpriority"), F.lit(","), time, price,
                    F.when(key % 31 == 0, ",extra").otherwise(""))
    path = scratch_path(spark, "dirty-csv")
    o.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("order_key", T.LongType()), T.StructField("asset_name", T.StringType()),
                           T.StructField("ts", T.TimestampNTZType()), T.StructField("price", T.DoubleType())])
    rows, rejected = FI.read_csv_lenient(spark, path, schema, "yyyy-MM-dd HH:mm:ss", header=False)
    return rows.withColumn("rejected", F.lit(False)).unionByName(
        rejected.select("line", F.lit(True).alias("rejected")), allowMissingColumns=True).select(
            "rejected", "line", *schema.names)
