"""The feature table: resample → indicators → target → metadata → drop incomplete rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType, StringType

from barline.config import FeatureConfig
from barline.operators.calendar import daily_resample
from barline.operators.indicators import add_indicators, indicator_columns


def feature_panel(prices: DataFrame, cfg: FeatureConfig = FeatureConfig(), key: str = "asset_name",
                  ts: str = "ts", value: str = "price", tie: str | None = "tie",
                  attrs: tuple[str, ...] = ()) -> DataFrame:
    """All indicator columns per asset and day, warm-up rows included (nulls kept)."""
    daily = daily_resample(prices, key, ts, value, tie, "close", attrs)
    return add_indicators(daily, cfg, key, "day", "close", target=True)


def feature_table(prices: DataFrame, cfg: FeatureConfig = FeatureConfig(), key: str = "asset_name",
                  ts: str = "ts", value: str = "price", tie: str | None = "tie",
                  asset_type: str | None = "asset_type", assets: DataFrame | None = None) -> DataFrame:
    """Per-asset feature rows with target and asset_type; rows with any null dropped.

    ``asset_type`` is taken from the input (one value per asset) when present.
    With ``assets`` (the configured asset dimension, F1/J4) only configured
    assets are processed and their type comes from the configuration; the
    dimension is configuration-sized and the planner picks the join.  A text price column is
    coerced to numbers first (P10); rows without a price are dropped (F2).
    """
    from barline.functions.numeric import to_numeric

    if isinstance(prices.schema[value].dataType, StringType):
        prices = prices.withColumn(value, to_numeric(value))
    if assets is not None:
        prices = prices.drop(*[c for c in ("asset_type",) if c in prices.columns])
        prices = prices.join(assets.select(key, "asset_type"), key, "inner")
        asset_type = "asset_type"
    attrs = (asset_type,) if asset_type and asset_type in prices.columns else ()
    panel = feature_panel(prices, cfg, key, ts, value, tie, attrs)
    cols = [key, "day", "close", *indicator_columns(cfg, True), *attrs]
    return complete(panel.select(*cols))


def complete(df: DataFrame) -> DataFrame:
    """The rows without a null or NaN, one condition a column.

    ``dropna`` makes a single predicate over all columns, of which Catalyst derives a variant for
    every set of renamed columns below it; conditions on one column each stay few.
    """
    whole = []
    for f in df.schema.fields:
        whole.append(f"`{f.name}` IS NOT NULL")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            whole.append(f"NOT isnan(`{f.name}`)")
    return df.where(" AND ".join(whole))
