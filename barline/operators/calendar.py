"""Calendar resampling: last price per day, every calendar day, forward filled.

Plan: one partial+final aggregate on ``(asset, day)`` shrinks raw rows to at
most one row per asset and day (map-side combine, so a hot asset is reduced
before the shuffle); then one window per asset finds the next observed day and
``explode(sequence(day, next_day - 1))`` writes the gap days carrying the
last price — gap filling and forward fill without a calendar join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.ordering import order_key


def daily_last(df: DataFrame, key: str = "asset_name", ts: str = "ts", value: str = "price",
               tie: str | None = None, out: str = "close", attrs: tuple[str, ...] = ()) -> DataFrame:
    """Last non-null ``value`` per (key, calendar day) by (ts, tie) order.

    ``attrs`` are columns that depend on the key only (e.g. asset_type); they
    ride along as grouping columns instead of costing a second scan.
    """
    order = order_key(df, ts, tie)
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(key, *attrs, F.to_date(ts).alias("day"))
        .agg(F.max_by(value, order).alias(out))
    )


def fill_calendar(daily: DataFrame, key: str = "asset_name", day: str = "day",
                  carry: tuple[str, ...] = ("close",)) -> DataFrame:
    """Emit every day between an asset's first and last observed day, forward filled."""
    w = Window.partitionBy(key).orderBy(day)
    spans = daily.withColumn("_until", F.coalesce(F.date_sub(F.lead(day).over(w), 1), F.col(day)))
    return spans.select(key, F.explode(F.sequence(F.col(day), F.col("_until"))).alias(day), *carry)


def daily_resample(df: DataFrame, key: str = "asset_name", ts: str = "ts", value: str = "price",
                   tie: str | None = "tie", out: str = "close", attrs: tuple[str, ...] = ()) -> DataFrame:
    """``resample('D').last().ffill()`` for all assets at once → (key, *attrs, day, out)."""
    daily = daily_last(df, key, ts, value, tie, out, attrs)
    return fill_calendar(daily, key, "day", (*attrs, out))
