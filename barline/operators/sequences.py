"""Scaling, look-back sequences, chronological splits and row alignment.

All per-asset windows here run over the daily feature table (calendar-bounded
per asset).  Sequences are built from ``lag`` expressions inside one window —
no Python loop, no collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def minmax_fit(df: DataFrame, key: str = "asset_name", x: str = "close", fit_filter: Column | None = None) -> DataFrame:
    """A2: adds x_min / x_max of ``x`` per asset (over rows matching ``fit_filter``, default all)."""
    w = Window.partitionBy(key)
    src = F.col(x) if fit_filter is None else F.when(fit_filter, F.col(x))
    return df.withColumn("x_min", F.min(src).over(w)).withColumn("x_max", F.max(src).over(w))


def scale(x: Column, lo: Column, hi: Column) -> Column:
    """P18 forward: (x − min)/(max − min); a constant column maps to 0.0."""
    rng = hi - lo
    return F.when(rng == 0, F.lit(0.0)).otherwise((x - lo) / rng)


def unscale(s: Column, lo: Column, hi: Column) -> Column:
    """P18 inverse: s·(max − min) + min."""
    return s * (hi - lo) + lo


def lookback(df: DataFrame, look_back: int, key: str = "asset_name", order: str = "day",
             x: str = "scaled", include_current: bool = False) -> DataFrame:
    """``seq`` = the ``look_back`` values before each row (oldest first), ``seq_idx``.

    Rows without a full history are dropped; ``seq_idx`` counts the kept rows
    from 1, so row i of the table pairs with sequence i (alignment J2).  With
    ``include_current`` the window ends at the row itself (live scoring).
    """
    w = Window.partitionBy(key).orderBy(order)
    first = 0 if include_current else 1
    lags = [F.lag(x, k).over(w) for k in range(look_back - 1 + first, first - 1, -1)]
    rn = F.row_number().over(w)
    need = look_back - 1 if include_current else look_back
    out = df.withColumn("_rn", rn).withColumn("seq", F.array(*lags))
    return out.where(F.col("_rn") > need).withColumn("seq_idx", F.col("_rn") - need).drop("_rn")


def chrono_split(df: DataFrame, ratios: Sequence[float] = (0.6, 0.2), key: str = "asset_name",
                 idx: str = "seq_idx", min_rows: int = 5) -> DataFrame:
    """Chronological split by position; cut points use ``int(n·r)`` in doubles.

    Two ratios give train/val/test, one gives train/test.  Assets with fewer
    than ``min_rows`` rows, or with an empty part, get no rows (no result).
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    cuts = []
    acc = 0.0
    for r in ratios:
        acc = acc + float(r)
        cuts.append(acc)
    names = ["train", "val", "test"] if len(ratios) == 2 else ["train", "test"]
    out = df.withColumn("_n", n)
    ends = [F.floor(F.col("_n").cast("double") * F.lit(c)) for c in cuts]
    label = F.when(F.col(idx) <= ends[0], names[0])
    if len(ends) == 2:
        label = label.when(F.col(idx) <= ends[1], names[1])
    label = label.otherwise(names[-1])
    nonempty = ends[0] >= 1
    for a, b in zip(ends, ends[1:]):
        nonempty = nonempty & (b > a)
    nonempty = nonempty & (F.col("_n") > ends[-1])
    return out.where((F.col("_n") >= min_rows) & nonempty).withColumn("split", label).drop("_n")


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("target", "asset_name", "asset_type", "close")) -> list[str]:
    """Model feature columns = everything except target, keys and close."""
    return [c for c in df.columns if c not in set(exclude)]
