"""Drift monitoring: reference/current split, a test per column (two-sample KS, or
chi-square where a column has few values), summary.

Fixed values of the source monitor: windows of 60 reference + 30 current rows
when an asset has more than 90 rows, otherwise a 0.66 split; the drop list
below; a column drifts when the KS p-value is below 0.05; an asset drifts
when the drifted share reaches 0.5; a column of at most 5 distinct values is tested
by chi-square.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_COLUMNS = ["timestamp", "day", "asset_name", "asset_type", "target", "lstm_pred"]
NON_STATIONARY = ["close", "ma_3", "ma_7", "ma_14", "bb_high", "bb_low", "lag_1", "lag_2", "lag_3", "macd",
                  "macd_signal"]
TAIL_ROWS, REFERENCE_ROWS = 90, 60
SMALL_SPLIT = 0.66
P_THRESHOLD = 0.05
SHARE_THRESHOLD = 0.5
KS_TERMS = 100
FEW_VALUES = 5
GAMMA_TERMS = 200


def drift_columns(df: DataFrame) -> list[str]:
    """Columns left after dropping keys and non-stationary features (absent ones ignored)."""
    drop = set(KEY_COLUMNS) | set(NON_STATIONARY)
    return [c for c in df.columns if c not in drop]


def split_reference_current(df: DataFrame, key: str = "asset_name", order: str = "day") -> DataFrame:
    """Adds ``side`` ('reference'/'current'); rows outside the last 90 are dropped.

    The daily series per asset is calendar-bounded, so a per-asset window is fine.
    """
    w_desc = Window.partitionBy(key).orderBy(F.col(order).desc())
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    ranked = df.withColumn("_rd", F.row_number().over(w_desc)).withColumn("_n", n)
    pos = F.col("_n") - F.col("_rd") + 1  # 1-based ascending position
    small_cut = F.floor(F.col("_n").cast("double") * F.lit(SMALL_SPLIT))
    side = F.when(
        F.col("_n") > TAIL_ROWS,
        F.when(F.col("_rd") > TAIL_ROWS - REFERENCE_ROWS, "reference").otherwise("current"),
    ).otherwise(F.when(pos <= small_cut, "reference").otherwise("current"))
    return ranked.where(F.col("_rd") <= TAIL_ROWS).withColumn("side", side).drop("_rd", "_n")


def ks_pvalue(n1: Column, n2: Column, d: Column, terms: int = KS_TERMS) -> Column:
    """Asymptotic two-sample KS p-value: Q(sqrt(n1 n2 / (n1 + n2)) · D), Kolmogorov series."""
    en = F.sqrt(n1 * n2 / (n1 + n2))
    lam = en * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.lit(2.0) * F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def exact_tail_probability(m: int, n: int, d: float) -> float:
    """P(D >= d) for two samples of sizes ``m`` and ``n`` under the null (no ties).

    Every interleaving of the pooled sorted sample is a monotone lattice path
    from (0, 0) to (m, n), all C(m+n, m) equally likely; after x reference and
    y current values the ECDF gap is |x/m - y/n|.  The paths whose gap stays
    below d satisfy |x n - y m| < d m n at every point; column by column their
    counts are a cumulative sum over the contiguous band of allowed y.  Columns
    are rescaled as they grow, so large samples do not overflow.
    """
    import math

    import numpy as np

    if m <= 0 or n <= 0 or d is None or math.isnan(d):
        return math.nan
    t = round(d * m * n)  # D·m·n is an integer at the point where the gap peaks
    if t <= 0:
        return 1.0
    y = np.arange(n + 1)
    col = (y * m < t).astype(np.float64)
    log_scale = 0.0
    for x in range(1, m + 1):
        band = np.abs(x * n - y * m) < t
        col = np.where(band, np.cumsum(np.where(band, col, 0.0)), 0.0)
        top = col.max()
        if top <= 0.0:
            return 1.0
        col /= top
        log_scale += math.log(top)
    if col[n] <= 0.0:
        return 1.0
    log_total = math.lgamma(m + n + 1) - math.lgamma(m + 1) - math.lgamma(n + 1)
    inside = math.exp(math.log(col[n]) + log_scale - log_total)
    return min(max(1.0 - inside, 0.0), 1.0)


def ks_exact_pvalue(n1: Column, n2: Column, d: Column) -> Column:
    """Exact two-sided KS p-value as a vectorised UDF over the (asset, column) table,
    which has one row per asset and tested column."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def _p(a: pd.Series, b: pd.Series, dd: pd.Series) -> pd.Series:
        return pd.Series([exact_tail_probability(int(i), int(j), float(k)) if pd.notna(i) and pd.notna(j)
                          and pd.notna(k) else None for i, j, k in zip(a, b, dd)], dtype="float64")

    return _p(n1, n2, d)


def ks_statistics(split: DataFrame, columns: Sequence[str], key: str = "asset_name",
                  exact: bool = False) -> DataFrame:
    """Per (asset, column) the KS distance D between reference and current values.

    Values are unpivoted to long form; each (asset, column) group holds at most
    90 rows.  ECDFs come from RANGE-frame running counts (ties share a step).
    ``exact`` selects the exact small-sample p-value (lattice-path count)
    instead of the asymptotic Kolmogorov series.
    """
    long = split.unpivot([key, "side"], list(columns), "column", "value").where(F.col("value").isNotNull())
    g = Window.partitionBy(key, "column")
    w = g.orderBy("value").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    is_ref = (F.col("side") == "reference").cast("long")
    is_cur = (F.col("side") == "current").cast("long")
    cdf = long.select(
        key, "column",
        F.try_divide(F.sum(is_ref).over(w), F.sum(is_ref).over(g)).alias("f_ref"),
        F.try_divide(F.sum(is_cur).over(w), F.sum(is_cur).over(g)).alias("f_cur"),
        F.sum(is_ref).over(g).alias("n_ref"),
        F.sum(is_cur).over(g).alias("n_cur"),
    )
    stats = cdf.groupBy(key, "column").agg(
        F.max(F.abs(F.col("f_ref") - F.col("f_cur"))).alias("ks_stat"),
        F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"))
    if exact:
        p = ks_exact_pvalue(F.col("n_ref"), F.col("n_cur"), F.col("ks_stat"))
    else:
        p = ks_pvalue(F.col("n_ref").cast("double"), F.col("n_cur").cast("double"), F.col("ks_stat"))
    # a side without values has no distance: the pair stays, with null results
    tested = F.when(F.col("ks_stat").isNotNull(), p)
    return stats.withColumn("p_value", tested).withColumn("drifted", F.col("p_value") < F.lit(P_THRESHOLD))


def _ln_gamma_halves(twice: Column) -> Column:
    """ln Gamma(twice / 2) for a whole ``twice`` >= 1, by Gamma(z + 1) = z Gamma(z)."""
    odd = twice % 2 == 1
    start = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    steps = F.floor((twice - 1) / 2).cast("int")
    factors = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(factors, F.when(odd, F.log(F.sqrt(F.pi()))).otherwise(F.lit(0.0)),
                       lambda acc, k: acc + F.log(start + k - 1))


def chi_square_pvalue(statistic: Column, dof: Column, terms: int = GAMMA_TERMS) -> Column:
    """Upper tail of the chi-square law, Q(dof / 2, statistic / 2), as one expression.

    The regularised incomplete gamma function by its power series below
    ``a + 1`` and by its continued fraction above, both folded from the last
    term back.  No degree of freedom (a constant column) gives 1, an infinite
    statistic 0, a missing one null.
    """
    a, x = dof.cast("double") / 2, statistic / 2
    last_first = F.sequence(F.lit(terms), F.lit(1), F.lit(-1))
    series = F.aggregate(last_first, F.lit(1.0), lambda acc, k: F.lit(1.0) + x / (a + k) * acc)
    tail = F.aggregate(last_first, F.lit(0.0), lambda acc, k: k * (k - a) / (x + 2 * k + 1 - a - acc))
    ln_front = a * F.log(x) - x - _ln_gamma_halves(dof.cast("int"))
    q = F.when(x < a + 1, F.lit(1.0) - F.exp(ln_front) / a * series).otherwise(F.exp(ln_front) / (x + 1 - a - tail))
    # greatest and least pass over nulls, so a missing statistic is told apart first
    return F.when(statistic.isNull(), F.lit(None).cast("double")).when((dof < 1) | (statistic <= 0), F.lit(1.0)).when(
        statistic == float("inf"), F.lit(0.0)).otherwise(F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0)))


def drift_tests(split: DataFrame, columns: Sequence[str], key: str = "asset_name",
                few_values: int = FEW_VALUES) -> DataFrame:
    """A21 with the test chosen by column: one row per (asset, column) with its
    ``n_values``, ``test`` ('ks' or 'chi_square'), statistic, p-value and flag.

    Values are counted per side once (partial aggregation); both statistics
    come from these counts.  KS: the largest gap of the two running shares.
    Chi-square, for at most ``few_values`` distinct values over both sides: current
    counts against the reference counts scaled to the current size; a value that
    the reference lacks makes it infinite.  Null and NaN are missing.  A side
    without values gives null results; a column without any gives no row.
    """
    # the split keeps at most 90 rows an asset, which bounds the window below
    value = F.nullif(F.col("value"), F.lit(float("nan")))
    long = split.select(F.col(key), "side", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [key, "side"], list(columns), "column", "value").withColumn("value", value).where(F.col("value").isNotNull())
    counts = long.groupBy(key, "column", "value").agg(
        F.count_if(F.col("side") == "reference").alias("ref"), F.count_if(F.col("side") == "current").alias("cur"))
    g = Window.partitionBy(key, "column")
    upto = g.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = counts.select(
        key, "column", "ref", "cur", F.sum("ref").over(g).alias("n_ref"), F.sum("cur").over(g).alias("n_cur"),
        F.sum("ref").over(upto).alias("below_ref"), F.sum("cur").over(upto).alias("below_cur"))
    gap = F.abs(F.try_divide(F.col("below_ref"), F.col("n_ref")) - F.try_divide(F.col("below_cur"), F.col("n_cur")))
    expected = F.try_divide(F.col("ref") * F.col("n_cur").cast("double"), F.col("n_ref"))
    part = F.when(expected > 0, (F.col("cur") - expected) * (F.col("cur") - expected) / expected).when(
        (expected == 0) & (F.col("cur") > 0), F.lit(float("inf")))
    stats = wide.groupBy(key, "column").agg(
        F.count(F.lit(1)).alias("n_values"), F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"),
        F.max(gap).alias("_ks"), F.sum(part).alias("_chi"))
    both, few = (F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.col("n_values") <= few_values
    p = F.when(few, chi_square_pvalue(F.col("_chi"), F.col("n_values") - 1)).otherwise(
        ks_pvalue(F.col("n_ref").cast("double"), F.col("n_cur").cast("double"), F.col("_ks")))
    tested = stats.select(
        key, "column", "n_values", "n_ref", "n_cur", F.when(few, "chi_square").otherwise("ks").alias("test"),
        F.when(both, F.when(few, F.col("_chi")).otherwise(F.col("_ks"))).alias("statistic"),
        F.when(both, p).alias("p_value"))
    return tested.withColumn("drifted", F.col("p_value") < F.lit(P_THRESHOLD))


def drift_summary(ks: DataFrame, key: str = "asset_name", threshold: float = SHARE_THRESHOLD) -> DataFrame:
    """Drifted share per asset, flag and the resulting action."""
    agg = ks.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if("drifted").alias("n_drifted"),
    )
    share = F.col("n_drifted").cast("double") / F.col("n_columns").cast("double")
    return agg.withColumn("drift_share", share).withColumn(
        "drift_detected", F.col("drift_share") >= F.lit(float(threshold))
    ).withColumn("action", F.when(F.col("drift_detected"), "retrain_and_alert").otherwise("none"))


def drift_report(ks: DataFrame, summary: DataFrame, key: str = "asset_name") -> DataFrame:
    """One nested report row per asset — summary fields plus the per-column
    tests as an array — keyed by the report file name (P20)."""
    from barline.functions.names import report_name_col

    cols = ks.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(
        "column", "ks_stat", "p_value", "drifted"))).alias("columns"))
    return summary.join(cols, key, "left").withColumn("report_name", report_name_col(F.col(key)))
