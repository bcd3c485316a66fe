"""Views over the driver tables that stand in for market data.

The driver tables hold no prices, so each operator runs on a view derived
from them (definitions in FIXTURES.md §2).  Every view reads its whole source
table and nothing is sampled or capped, but the features of ``requests`` leave out
the events of types from 'p' on, as the oracle SQL does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.config import Config
from barline.operators.sequential import blocked_lag, blocked_row_number
from barline.sources.tables import nan_to_null, read_table

# Configured assets of the fixture world: five order priorities exist in the
# data, two configured names do not (exercises the "missing assets" warning).
FIXTURE_CONFIG = Config(
    stocks=("1-URGENT", "2-HIGH", "0-ABSENT"),
    cryptos=("3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-GHOST"),
)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(asset_name, asset_type, ts, tie, price) — one row per order."""
    o = nan_to_null(read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_totalprice",
                               "o_orderpriority"))
    return o.select(
        F.col("o_orderpriority").alias("asset_name"),
        F.when(F.col("o_orderpriority") < F.lit("3"), "stock").otherwise("crypto").alias("asset_type"),
        F.col("o_orderdate").cast(T.TimestampNTZType()).alias("ts"),
        F.col("o_orderkey").alias("tie"),
        F.col("o_totalprice").alias("price"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly OHLCV bars per event type: open/close at the first/last (ts, event_id)."""
    e = nan_to_null(read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value"))
    hour = F.date_trunc("hour", F.col("ts")).cast(T.TimestampNTZType())
    order = F.struct("ts", "event_id")
    return (
        e.groupBy(F.col("event_type").alias("asset_name"), hour.alias("timestamp"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as a price download lands them: capitalised names, ``Datetime`` column."""
    b = bars(spark, sf_dir)
    return b.select(
        F.col("asset_name").alias("Ticker"),
        F.col("timestamp").alias("Datetime"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a messy numeric text column ``raw`` (ten patterns by key % 10)."""
    o = nan_to_null(read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate",
                               "o_orderpriority", "o_totalprice"))
    c = F.col("o_custkey").cast("string")
    m = F.col("o_orderkey") % 10
    raw = (
        F.when(m == 0, F.concat(F.lit("$"), c, F.lit(",000.5")))
        .when(m == 1, F.concat(c, F.lit(".25M")))
        .when(m == 2, F.concat(c, F.lit("b")))
        .when(m == 3, F.concat(c, F.lit(".5%")))
        .when(m == 4, F.lit("nan"))
        .when(m == 5, F.lit(None).cast("string"))
        .when(m == 6, F.lit("invalidM"))
        .when(m == 7, F.concat(F.lit(" "), c, F.lit(" ")))
        .when(m == 8, F.concat(F.lit("-"), c, F.lit(".75")))
        .otherwise(F.concat(c, F.lit("K")))
    )
    return o.withColumn("raw", raw)


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(asset_name, ts, tie, y_true, y_pred): y_pred is the asset's previous price."""
    p = prices(spark, sf_dir).withColumn("_day", F.to_date("ts"))
    lagged = blocked_lag(p, ["asset_name"], "_day", ["ts", "tie"], ["price"])
    return lagged.where(F.col("price_prev").isNotNull()).select(
        "asset_name", "ts", "tie", F.col("price").alias("y_true"), F.col("price_prev").alias("y_pred")
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking-server run records, one per order."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate",
                   "o_orderpriority", "o_totalprice")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("run_id"),
        F.concat(F.lit("m_"), F.col("o_orderpriority")).alias("model_name"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED")
        .when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("FAILED").alias("status"),
        F.col("o_orderdate").cast(T.TimestampNTZType()).alias("start_time"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / 10.0).alias("rmse"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / 12.5).alias("mae"),
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model versions: version = row number per model in (date, key) order, as text."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    o = o.select(
        F.concat(F.lit("m_"), F.col("o_orderpriority")).alias("model_name"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").alias("_d"),
        F.to_date("o_orderdate").alias("_day"),
    )
    numbered = blocked_row_number(o, ["model_name"], "_day", ["_d", "run_id"], "_v")
    return numbered.select("model_name", F.col("_v").cast("string").alias("version"), "run_id")


def aliases(spark: SparkSession, sf_dir: str, versions_df: DataFrame | None = None) -> DataFrame:
    """Champion aliases: version 1 everywhere, newest for ``m_2*``, none for ``m_5*``.

    Pass the ``versions`` frame already in use to share its lineage.
    """
    v = versions_df if versions_df is not None else versions(spark, sf_dir)
    newest = v.groupBy("model_name").agg(F.max(F.col("version").cast("long")).alias("_newest"))
    champ = (
        newest.where(~F.col("model_name").startswith("m_5"))
        .select(
            "model_name",
            F.lit("Champion").alias("alias"),
            F.when(F.col("model_name").startswith("m_2"), F.col("_newest"))
            .otherwise(F.lit(1)).cast("string").alias("version"),
        )
    )
    return champ


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request (request_id, asset_name, payload) per user and period, from the user's first period to the last.

    A user's periods last 1 + user_id mod 8 days, counted from 2024-01-01.  The payload is a JSON list
    with an object per event of the period, oldest first: its value as ``close``, the entries of its
    ``props`` and its type as a key, so objects differ in their keys.  Quiet periods give empty lists.
    Where (user_id + period) mod 23 is 0 a second request, -1 - request_id, holds the first half of the
    payload only: a sending that broke off.  Every event is in one whole payload.
    """
    e = nan_to_null(read_table(spark, sf_dir, "events"))
    days = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    e = e.withColumn("period", F.floor(days / (1 + F.col("user_id") % 8)))
    row = F.map_concat(F.create_map(F.lit("close"), F.col("value")), F.from_json("props", "map<string,double>"),
                       F.create_map(F.col("event_type"), F.lit(1.0)))
    e = e.select("user_id", "period", F.struct("ts", "event_id", F.to_json(row).alias("json")).alias("row"))
    out = e.groupBy("user_id", "period").agg(F.sort_array(F.collect_list("row"))["json"].alias("rows"))
    later = F.lead("period").over(Window.partitionBy("user_id").orderBy("period"))
    out = out.withColumn("until", F.coalesce(later - 1, F.col("period")))
    out = out.select("user_id", "period", "rows", F.explode(F.sequence("period", "until")).alias("at"))
    text = F.concat(F.lit("["), F.when(F.col("at") == F.col("period"), F.array_join("rows", ",")).otherwise(F.lit("")), F.lit("]"))
    sent = out.withColumn("payload", text).select(
        (F.col("user_id") * 1000 + F.col("at")).cast("long").alias("id"),
        F.when(F.col("user_id") % 6 == 5, "unknown").otherwise("known").alias("asset_name"), "payload",
        ((F.col("user_id") + F.col("at")) % 23 == 0).alias("twice"))
    whole = F.struct(F.col("id").alias("request_id"), F.col("payload").alias("payload"))
    half = F.struct((-1 - F.col("id")).alias("request_id"), F.substring(
        "payload", F.lit(1), F.floor(F.length("payload") / 2).cast("int")).alias("payload"))
    return sent.select("asset_name", F.inline(F.when(F.col("twice"), F.array(whole, half)).otherwise(F.array(whole)))).select(
        "request_id", "asset_name", "payload")


def _cents(c: str):
    return F.floor(F.col(c) * F.lit(100.0)).cast("long").cast("string")


def raw_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stock table as scraped: messy headers, numbers as text, a junk column."""
    b = bars(spark, sf_dir)
    diff_cents = F.floor((F.col("close") - F.col("open")) * F.lit(100.0)).cast("long").cast("string")
    vol = F.col("volume").cast("string")
    return b.select(
        F.col("timestamp").cast("string").alias("Timestamp"),
        F.when(F.col("volume") == 1, F.lit(None).cast("string")).otherwise(F.col("asset_name")).alias("Name"),
        F.concat(F.lit("$"), _cents("close")).alias("Last"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        (F.col("close") - F.col("open")).alias("Chg_"),
        F.concat(diff_cents, F.lit("%")).alias("Chg_%"),
        F.when(F.col("volume") % 4 == 0, F.concat(vol, F.lit("M")))
        .when(F.col("volume") % 4 == 1, F.concat(vol, F.lit("B")))
        .when(F.col("volume") % 4 == 2, F.concat(vol, F.lit("%")))
        .otherwise(F.lit("n/a")).alias("Vol."),
        F.lit("x").alias("Notes"),
    )


def raw_crypto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crypto table as scraped: quoted prices, market cap in millions, no total_vol."""
    b = bars(spark, sf_dir)
    return b.select(
        F.col("timestamp").cast("string").alias("Timestamp"),
        F.concat(F.upper("asset_name"), F.lit("-USD")).alias("Name"),
        F.upper("asset_name").alias("Symbol"),
        F.when(F.col("volume") == 2, F.lit("--"))
        .otherwise(F.concat(F.lit('"'), _cents("close"), F.lit('"'))).alias("Price_USD"),
        F.col("volume").alias("Vol_24h"),
        (F.col("close") - F.col("open")).alias("Chg_24h"),
        F.concat(_cents("high"), F.lit("M")).alias("Market_Cap"),
        F.lit(1).alias("Junk!"),
    )


def stock_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised bars of the 'stock' event types (names before 'p')."""
    from barline.operators.cleaning import normalise_bars

    return normalise_bars(raw_bars(spark, sf_dir)).where(F.col("asset_name") < F.lit("p"))


def crypto_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised bars of the 'crypto' event types, named like ``VIEW-USD``."""
    from barline.operators.cleaning import normalise_bars

    b = normalise_bars(raw_bars(spark, sf_dir)).where(F.col("asset_name") >= F.lit("p"))
    return b.withColumn("asset_name", F.concat(F.upper("asset_name"), F.lit("-USD")))
