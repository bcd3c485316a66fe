"""Raw-table cleaning and shaping (bars, stock and crypto tables).

All of it is projection work: renames, Catalyst string/number expressions and
one per-asset window (``chg_7d``) over already aggregated bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions.names import HEADER_SYNONYMS, clean_name
from barline.functions.numeric import clean_numeric, ratio, ratio_or_null
from barline.operators.sequential import blocked_ffill, blocked_shift

BAR_FIELDS = ("Date", "Datetime", "Open", "High", "Low", "Close", "Adj Close", "Volume")
# The column lists of the cleaned tables, in their order.
STOCK_COLUMNS = ["timestamp", "name", "last", "high", "low", "chg_abs", "chg_pct", "vol"]
STOCK_NUMERIC = ["last", "high", "low", "chg_abs", "vol", "chg_pct"]
CRYPTO_COLUMNS = ["timestamp", "name", "symbol", "price_usd", "vol_24h", "total_vol", "chg_24h", "chg_7d",
                  "market_cap"]
CRYPTO_NUMERIC = ["price_usd", "vol_24h", "total_vol", "chg_24h", "chg_7d", "market_cap"]


class DuplicateColumnError(ValueError):
    pass


def _rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    if len(set(names)) != len(names):
        dupes = sorted({n for n in names if names.count(n) > 1})
        raise DuplicateColumnError(f"columns collide after cleaning: {dupes}")
    return df.toDF(*names)


def flatten_bar_columns(df: DataFrame, sep: str = "_") -> DataFrame:
    """Two-level bar names (``Close_AAPL`` or ``('Close', 'AAPL')``) → first level."""
    out = []
    for c in df.columns:
        m = _tuple_name(c)
        if m is not None:
            out.append(m)
            continue
        head = c.split(sep, 1)[0]
        out.append(head if head in BAR_FIELDS and c != head else c)
    return _rename_all(df, out)


def _tuple_name(c: str) -> str | None:
    import re

    m = re.match(r"^\(\s*'([^']*)'\s*,\s*'[^']*'\s*\)$", c)
    return m.group(1) if m else None


def normalise_bars(df: DataFrame, ticker: str | None = "Ticker") -> DataFrame:
    """Flatten names, ``Date``/``Datetime`` → ``timestamp``, ticker → ``asset_name``."""
    df = flatten_bar_columns(df)
    if "Date" in df.columns:
        df = df.withColumnRenamed("Date", "timestamp")
    elif "Datetime" in df.columns:
        df = df.withColumnRenamed("Datetime", "timestamp")
    if ticker and ticker in df.columns:
        df = df.withColumnRenamed(ticker, "asset_name")
    return df


def bar_changes(df: DataFrame) -> DataFrame:
    """chg_abs = Close − Open; chg_pct = chg_abs / Open × 100 (Open = 0 → null)."""
    chg = F.col("Close") - F.col("Open")
    return df.withColumns({
        "chg_abs": chg,
        "chg_pct": ratio_or_null(chg, F.col("Open")) * F.lit(100.0),
    })


def _existing(df: DataFrame, wanted: list[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in wanted if c in have]


def stock_shape(bars: DataFrame, name_col: str = "asset_name") -> DataFrame:
    """P5 (stocks): name, Close→last, High→high, Low→low, Volume→vol, ordered projection."""
    df = bar_changes(bars).withColumn("name", F.col(name_col))
    df = df.withColumnsRenamed({"Close": "last", "High": "high", "Low": "low", "Volume": "vol"})
    return df.select(*_existing(df, STOCK_COLUMNS))


def _block_of(df: DataFrame, order: str):
    """A column that never falls along ``order``: the day of a time, also of one as text, or 64 numbers a block."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.StringType):
        return F.substring(order, 1, 10)
    return F.floor(F.col(order) / 64) if isinstance(kind, T.NumericType) else F.to_date(order)


def crypto_shape(bars: DataFrame, name_col: str = "asset_name", order: str = "timestamp") -> DataFrame:
    """P3/P4/P5/W15 (cryptos): symbol, 7-row pct change, market-cap proxy, renames.

    The change is over forward-filled closes.  Fill and lag are block-wise by day, so the bars of
    one asset are spread over tasks; bars without a time come first, in a block of their own.
    """
    df = bar_changes(bars).withColumn("name", F.col(name_col)).withColumn("_day", _block_of(bars, order))
    df = blocked_ffill(df, [name_col], "_day", [order], ["Close"])
    df = blocked_shift(df, [name_col], "_day", [order], ["Close_filled"], 7)
    df = df.withColumns({
        "symbol": F.split_part(F.col("name"), F.lit("-"), F.lit(1)),
        "chg_7d": (ratio(F.col("Close_filled"), F.col("Close_filled_prev")) - F.lit(1.0)) * F.lit(100.0),
        "market_cap": F.col("Close") * F.lit(1e6),
    })
    df = df.withColumnsRenamed({"Close": "price_usd", "Volume": "vol_24h", "chg_pct": "chg_24h"})
    df = df.withColumn("total_vol", F.col("vol_24h"))
    return df.select(*_existing(df, CRYPTO_COLUMNS))


def clean_columns(df: DataFrame, synonyms: dict[str, str] | None = None) -> DataFrame:
    """Lower-case names, apply header synonyms (if given), strip other characters."""
    names = [c.lower() for c in df.columns]
    if synonyms:
        names = [synonyms.get(n, n) for n in names]
    return _rename_all(df, [clean_name(n) for n in names])


def _numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    updates = {}
    for c in cols:
        if c in types:
            updates[c] = (F.col(c).cast("double") if isinstance(types[c], T.NumericType)
                          else clean_numeric(F.col(c)))
    return df.withColumns(updates) if updates else df


def parse_timestamp(c: str, lenient: bool = False):
    """Text → timestamp_ntz; strict parsing raises on bad text, lenient gives null."""
    text = F.col(c).cast("string")
    if lenient:
        return F.try_to_timestamp(text).cast(T.TimestampNTZType())
    return F.to_timestamp_ntz(text)


def _with_timestamp(df: DataFrame, lenient: bool) -> DataFrame:
    if "timestamp" not in df.columns:
        return df
    t = df.schema["timestamp"].dataType
    if isinstance(t, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return df.withColumn("timestamp", F.col("timestamp").cast(T.TimestampNTZType()))
    return df.withColumn("timestamp", parse_timestamp("timestamp", lenient))


def preprocess_stocks(raw: DataFrame, lenient_timestamps: bool = False) -> DataFrame:
    """P11 (stocks): synonyms → clean names → keep known columns → types → drop rows without last/name."""
    df = clean_columns(raw, HEADER_SYNONYMS)
    df = df.select(*_existing(df, STOCK_COLUMNS))
    df = _numeric(_with_timestamp(df, lenient_timestamps), STOCK_NUMERIC)
    return df.dropna(subset=_existing(df, ["last", "name"]))


def preprocess_crypto(raw: DataFrame, lenient_timestamps: bool = False) -> DataFrame:
    """P11 (crypto): clean names → keep known columns → types → drop rows without price/name."""
    df = clean_columns(raw)
    df = df.select(*_existing(df, CRYPTO_COLUMNS))
    df = _numeric(_with_timestamp(df, lenient_timestamps), CRYPTO_NUMERIC)
    return df.dropna(subset=_existing(df, ["price_usd", "name"]))
