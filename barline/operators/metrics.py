"""Forecast-quality metrics per group, in one aggregate pass.

RMSE, MAE, MAPE (only y ≠ 0 rows; none → +inf), range-normalised RMSE
(range 0 → +inf) and directional accuracy (share of consecutive pairs whose
change has the same sign in truth and prediction, ×100; fewer than two rows →
0.0; a zero change is its own sign class).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.numeric import INF
from barline.operators.sequential import blocked_lag


def _error_aggs(y: str, p: str) -> list:
    err = F.col(y) - F.col(p)
    rmse = F.sqrt(F.avg(err * err))
    nz = F.col(y) != 0
    mape = F.avg(F.when(nz, F.abs(err / F.col(y)))) * F.lit(100.0)
    rng = F.max(y) - F.min(y)
    return [
        rmse.alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.coalesce(mape, F.lit(INF)).alias("mape"),
        F.when(rng == 0, F.lit(INF)).otherwise(rmse / rng).alias("minmax_rmse"),
        F.count(F.lit(1)).alias("n"),
    ]


def _lagged(df: DataFrame, keys: Sequence[str], block: str | None, order: Sequence[str], y: str, p: str) -> DataFrame:
    if block is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({y + "_prev": F.lag(y).over(w), p + "_prev": F.lag(p).over(w)})
    return blocked_lag(df, keys, block, order, [y, p])


def _da_agg(y: str, p: str):
    same = F.signum(F.col(y) - F.col(y + "_prev")) == F.signum(F.col(p) - F.col(p + "_prev"))
    has_prev = F.col(y + "_prev").isNotNull()
    return F.coalesce(F.avg(F.when(has_prev, same.cast("double"))) * F.lit(100.0), F.lit(0.0)) \
        .alias("directional_accuracy")


def error_metrics(df: DataFrame, keys: Sequence[str], y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """A15–A18 per group (one aggregate, partial aggregation map-side)."""
    return df.groupBy(*keys).agg(*_error_aggs(y, p))


def directional_accuracy(df: DataFrame, keys: Sequence[str], block: str | None, order: Sequence[str],
                         y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """A19 per group; consecutive rows are found block-wise (hot groups stay split).

    ``block=None`` uses a plain per-group window (for calendar-bounded series).
    """
    return _lagged(df, keys, block, order, y, p).groupBy(*keys).agg(_da_agg(y, p))


def evaluate(df: DataFrame, keys: Sequence[str], block: str | None, order: Sequence[str],
             y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """All five metrics per group from one lag pass and one aggregate."""
    return _lagged(df, keys, block, order, y, p).groupBy(*keys).agg(*_error_aggs(y, p), _da_agg(y, p))
