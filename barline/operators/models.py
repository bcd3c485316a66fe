"""Model jobs: look-back regressor (stage 1) and boosted trees (stage 2).

Stage 1 maps the ``look_back`` previous scaled closes to the next scaled close
with a per-asset ridge least-squares model.  The Gram matrix ``Z'Z`` and
``Z'y`` (Z = [1, x_1..x_L]) are summed by one ``groupBy(asset).agg`` with
map-side partial aggregation — the data never leaves the executors — and only
the (L+1)x(L+1) system per asset is solved, vectorised with numpy inside
``mapInPandas`` over the tiny per-asset Gram table.

Stage 2, boosted trees per asset on the feature rows plus the stage-1 prediction
(``lstm_pred``), is in ``boosting``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gram(seqs: DataFrame, look_back: int, key: str = "asset_name", seq: str = "seq", y: str = "y") -> DataFrame:
    """Per-asset sums of z_i z_j (i ≤ j), z_i y and the row count, in one aggregate."""
    z: list[Column] = [F.lit(1.0)] + [F.col(seq)[i] for i in range(look_back)]
    aggs = []
    for i in range(look_back + 1):
        for j in range(i, look_back + 1):
            aggs.append(F.sum(z[i] * z[j]).alias(f"g_{i}_{j}"))
    for i in range(look_back + 1):
        aggs.append(F.sum(z[i] * F.col(y)).alias(f"b_{i}"))
    aggs.append(F.count(F.lit(1)).alias("n"))
    return seqs.groupBy(key).agg(*aggs)


def solve_ridge(gram_df: DataFrame, look_back: int, ridge: float, key: str = "asset_name") -> DataFrame:
    """(key, weights[intercept, w_1..w_L], n): solves (Z'Z + ridge·I') w = Z'y per asset.

    The intercept is not penalised.  A singular system falls back to least squares.
    """
    m = look_back + 1
    schema = f"{key} string, weights array<double>, n long"

    def solve(batches):
        for pdf in batches:
            k = len(pdf)
            if k == 0:
                continue
            g = np.zeros((k, m, m))
            for i in range(m):
                for j in range(i, m):
                    v = pdf[f"g_{i}_{j}"].to_numpy(dtype=float)
                    g[:, i, j] = v
                    g[:, j, i] = v
            b = np.stack([pdf[f"b_{i}"].to_numpy(dtype=float) for i in range(m)], axis=1)
            pen = np.eye(m) * ridge
            pen[0, 0] = 0.0
            weights = []
            for a in range(k):
                lhs = g[a] + pen
                try:
                    w = np.linalg.solve(lhs, b[a])
                except np.linalg.LinAlgError:
                    w = np.linalg.lstsq(lhs, b[a], rcond=None)[0]
                weights.append(w.tolist())
            yield pd.DataFrame({key: pdf[key], "weights": weights, "n": pdf["n"].astype("int64")})

    return gram_df.mapInPandas(solve, schema)


def fit_lookback(seqs: DataFrame, look_back: int, ridge: float, key: str = "asset_name") -> DataFrame:
    """M1: per-asset stage-1 weights from the training sequences."""
    return solve_ridge(gram(seqs, look_back, key), look_back, ridge, key)


def lookback_predict(seq: Column, weights: Column, look_back: int) -> Column:
    """w_0 + Σ w_i x_i as a higher-order-function expression (stays in the JVM)."""
    prods = F.zip_with(seq, F.slice(weights, 2, look_back), lambda a, b: a * b)
    return F.try_element_at(weights, F.lit(1)) + F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def last_row(df: DataFrame, key: str = "asset_name", order: str = "day") -> DataFrame:
    """The newest row per asset (top-1, pushed below the shuffle)."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 1).drop("_r")
