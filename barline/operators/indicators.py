"""Technical indicators over a daily panel (one row per asset and day).

All window indicators share one ``WindowSpec`` (partition by asset, order by
day), so Catalyst plans a single exchange and sort for the whole chain.  The
recursive EMA family (MACD, signal, RSI) runs through blocks of days
(``linear_scan.ema_scan``), window functions and joins throughout.
Each asset's partition is its daily series, whose length is bounded by the
calendar, not by the raw row count.

Conventions (published definitions of the indicators):
* rolling statistics need a full window (null during warm-up);
* EMA: seeded with the first value, no bias adjustment, null until ``span``
  values (MACD) or ``window`` values (RSI, alpha = 1/window);
* Bollinger sigma is the population std, volatility the sample std;
* division by zero follows float rules (±inf, 0/0 missing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.config import FeatureConfig
from barline.functions.numeric import natural_log, ratio, ratio_or_null
from barline.operators.linear_scan import WIDTH, Average, ema_scan, span_alpha


def panel_window(key: str = "asset_name", order: str = "day") -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def _rolling(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def returns(x: str, w: WindowSpec) -> dict[str, Column]:
    prev = F.lag(x, 1).over(w)
    r = ratio(F.col(x), prev)
    return {"return": r - F.lit(1.0), "log_return": natural_log(r)}


def moving_average(x: str, w: WindowSpec, n: int) -> Column:
    return F.when(F.row_number().over(w) >= n, F.avg(x).over(_rolling(w, n)))


def rolling_std(x: str, w: WindowSpec, n: int, sample: bool = True) -> Column:
    fn = F.stddev_samp if sample else F.stddev_pop
    return F.when(F.row_number().over(w) >= n, fn(x).over(_rolling(w, n)))


def bollinger(x: str, w: WindowSpec, n: int, dev: float) -> dict[str, Column]:
    mavg = F.avg(x).over(_rolling(w, n))
    mstd = F.stddev_pop(x).over(_rolling(w, n))
    full = F.row_number().over(w) >= n
    return {
        "bb_high": F.when(full, mavg + F.lit(float(dev)) * mstd),
        "bb_low": F.when(full, mavg - F.lit(float(dev)) * mstd),
    }


def position(df: DataFrame, order: str) -> Column:
    """A whole number that orders the rows: the number of the day, or the column itself."""
    return F.unix_date(order) if isinstance(df.schema[order].dataType, T.DateType) else F.col(order).cast("long")


def ema_family(daily: DataFrame, cfg: FeatureConfig = FeatureConfig(), key: str = "asset_name",
               order: str = "day", x: str = "close", keep_emas: bool = False, block: int = WIDTH) -> DataFrame:
    """MACD line, signal, histogram and RSI, the recursive (EMA) indicators, by the blocked recursion.

    One scan gives the fast and slow averages and the averages of gains and losses,
    a second one the signal, whose input starts where the MACD line does.
    """
    n_rsi, pos = cfg.rsi_window, position(daily, order)
    diff = F.col(x) - F.lag(x).over(panel_window(key, order))
    rows = daily.withColumn("_diff", diff).withColumns({
        "_up": F.greatest(F.coalesce("_diff", F.lit(0.0)), F.lit(0.0)),
        "_down": F.greatest(-F.coalesce("_diff", F.lit(0.0)), F.lit(0.0)),
    })
    rows = ema_scan(rows, [key], pos, {
        "ema_fast": Average(x, span_alpha(cfg.macd_fast), cfg.macd_fast),
        "ema_slow": Average(x, span_alpha(cfg.macd_slow), cfg.macd_slow),
        "_gain": Average("_up", 1.0 / n_rsi, n_rsi), "_loss": Average("_down", 1.0 / n_rsi, n_rsi)}, block)
    rows = rows.withColumn("macd", F.col("ema_fast") - F.col("ema_slow"))
    rows = ema_scan(rows, [key], pos, {"macd_signal": Average("macd", span_alpha(cfg.macd_signal), cfg.macd_signal)}, block)
    strength = F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + F.try_divide("_gain", "_loss"))
    rows = rows.withColumns({
        "macd_diff": F.col("macd") - F.col("macd_signal"),
        "rsi": F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(strength),
    })
    emas = ["ema_fast", "ema_slow"] if keep_emas else []
    return rows.select(*daily.columns, "macd", "macd_signal", "macd_diff", "rsi", *emas)


def add_indicators(daily: DataFrame, cfg: FeatureConfig = FeatureConfig(), key: str = "asset_name",
                   order: str = "day", x: str = "close", target: bool = True) -> DataFrame:
    """Returns, MAs, MACD, RSI, Bollinger, volatility, lags and next-day target.

    Column order follows the source pipeline: close, return, log_return,
    ma_*, macd, macd_signal, macd_diff, rsi, bb_*, volatility_*, lag_*, target.
    """
    w = panel_window(key, order)
    first = {}
    first.update(returns(x, w))
    for n in cfg.moving_averages:
        first[f"ma_{n}"] = moving_average(x, w, n)
    first.update(bollinger(x, w, cfg.bollinger_window, cfg.bollinger_dev))
    first[f"volatility_{cfg.volatility_window}"] = rolling_std(x, w, cfg.volatility_window, sample=True)
    for k in cfg.lags:
        first[f"lag_{k}"] = F.lag(x, k).over(w)
    if target:
        first["target"] = F.lead(x, 1).over(w)

    # window indicators first (one exchange and sort on asset); the scans of the recursive family reuse its partitioning
    stage2 = daily.select("*", *[c.alias(name) for name, c in first.items()])
    stage2 = stage2.withColumns({
        "bb_width": ratio_or_null(F.col("bb_high") - F.col("bb_low"), F.col(x)),
        "bb_position": ratio_or_null(F.col(x) - F.col("bb_low"), F.col("bb_high") - F.col("bb_low")),
    })
    stage2 = ema_family(stage2, cfg, key, order, x)
    return stage2.select(*daily.columns, *indicator_columns(cfg, target))


def indicator_columns(cfg: FeatureConfig = FeatureConfig(), target: bool = True) -> list[str]:
    cols = ["return", "log_return"]
    cols += [f"ma_{n}" for n in cfg.moving_averages]
    cols += ["macd", "macd_signal", "macd_diff", "rsi", "bb_high", "bb_low", "bb_width", "bb_position"]
    cols += [f"volatility_{cfg.volatility_window}"]
    cols += [f"lag_{k}" for k in cfg.lags]
    if target:
        cols.append("target")
    return cols

