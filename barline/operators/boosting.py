"""Boosted regression trees per asset (stage 2).

One model per asset, any number of assets: Spark groups the rows by asset and a
small numpy kernel fits each group (squared error, level-wise histogram splits,
L2 penalty 1, row subsampling per tree).  A group is one asset's daily rows, so
it is bounded by the calendar, and rows are put in day order first: the model
does not depend on how the rows were partitioned.  A model is one binary value,
so a table of models can be written, read and joined like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barline.config import BoostParams

BINS = 64
PENALTY = 1.0


def fit_trees(x: np.ndarray, y: np.ndarray, params: BoostParams, seed: int) -> bytes:
    """Rows of (feature, threshold, left child, value), a leaf having feature -1; trees follow one another.

    The first row holds the mean of ``y`` as its value and the number of trees
    as its threshold.  Children are adjacent, and a missing value goes left.
    """
    rng = np.random.default_rng(seed)
    n, width = x.shape
    cuts = [np.unique(np.quantile(c[~np.isnan(c)], np.linspace(0, 1, BINS + 1)[1:-1])) if (~np.isnan(c)).any() else np.zeros(0)
            for c in x.T]
    bins = np.stack([np.where(np.isnan(c), 0, np.searchsorted(k, c, side="left")) for k, c in zip(cuts, x.T)]) if width else \
        np.zeros((0, n), np.int64)
    base = float(y.mean()) if n else 0.0
    rest, nodes = y - base, [(-1.0, float(params.n_estimators), 0.0, base)]
    for _ in range(params.n_estimators if n else 0):
        drawn = rng.random(n) < params.subsample
        at = np.zeros(n, np.int64)  # each row's node within the level, -1 once in a leaf
        level, root, made = 1, len(nodes), np.zeros(n)
        nodes.append((-1.0, 0.0, 0.0, 0.0))
        ids = [root]
        for depth in range(params.max_depth + 1):
            own = drawn & (at >= 0)
            weight = np.bincount(at[own], minlength=level).astype(float)
            total = np.bincount(at[own], rest[own], minlength=level)
            value = params.learning_rate * total / (weight + PENALTY)
            gain, best, cut = np.full(level, 1e-12), np.full(level, -1), np.zeros(level, np.int64)
            if depth < params.max_depth:
                for f in range(width):
                    key = at[own] * BINS + bins[f, own]
                    w = np.cumsum(np.bincount(key, minlength=level * BINS).reshape(level, BINS), axis=1)[:, :-1]
                    g = np.cumsum(np.bincount(key, rest[own], minlength=level * BINS).reshape(level, BINS), axis=1)[:, :-1]
                    rw, rg = weight[:, None] - w, total[:, None] - g
                    score = np.where((w >= 1) & (rw >= 1), g * g / (w + PENALTY) + rg * rg / (rw + PENALTY), -np.inf)
                    top = score.argmax(axis=1)
                    found = score[np.arange(level), top] - total * total / (weight + PENALTY)
                    better = found > gain
                    gain, best, cut = np.where(better, found, gain), np.where(better, f, best), np.where(better, top, cut)
            children = np.cumsum(best >= 0) - 1
            first = len(nodes)
            for k, node in enumerate(ids):
                nodes[node] = (-1.0, 0.0, 0.0, value[k]) if best[k] < 0 else (
                    float(best[k]), float(cuts[best[k]][cut[k]]), float(first + 2 * children[k]), value[k])
            live = at >= 0
            here = np.where(live, at, 0)
            leaf, split = live & (best[here] < 0), live & (best[here] >= 0)
            made[leaf] = value[here[leaf]]
            right = bins[best[here[split]], np.flatnonzero(split)] > cut[here[split]]
            at = np.full(n, -1)
            at[split] = 2 * children[here[split]] + right
            level = 2 * int((best >= 0).sum())
            if not level:
                break
            ids = list(range(first, first + level))
            nodes += [(-1.0, 0.0, 0.0, 0.0)] * level
        rest = rest - made
    return np.array(nodes).tobytes()


def predict_trees(model: bytes, x: np.ndarray) -> np.ndarray:
    """Predictions for rows of features in the fitted order."""
    nodes = np.frombuffer(model).reshape(-1, 4)
    feature, threshold, left, value = nodes[:, 0].astype(int), nodes[:, 1], nodes[:, 2].astype(int), nodes[:, 3]
    out = np.full(len(x), value[0])
    inner = feature >= 0
    child = np.zeros(len(nodes), bool)
    child[left[inner]] = child[left[inner] + 1] = True
    roots = np.flatnonzero(~child)[1:]
    rows = np.arange(len(x))
    for root in roots:
        at = np.full(len(x), root)
        while (down := inner[at]).any():
            node = at[down]
            at[down] = left[node] + (x[rows[down], feature[node]] > threshold[node])
        out += value[at]
    return out


def _matrix(pdf: pd.DataFrame, cols: Sequence[str]) -> np.ndarray:
    return pdf[list(cols)].to_numpy(dtype=float).reshape(len(pdf), len(cols))


def fit_boost(train: DataFrame, feature_cols: Sequence[str], params: BoostParams, seed: int = 42,
              label: str = "target", key: str = "asset_name", order: str = "day") -> DataFrame:
    """M2: (asset_name, model), one fitted model per asset; rows without a label are left out."""
    cols = list(feature_cols)

    def fit(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf[label].notna()].sort_values([order, *cols], kind="stable")
        return pd.DataFrame({key: [name[0]], "model": [fit_trees(_matrix(pdf, cols), pdf[label].to_numpy(float), params, seed)]})

    schema = T.StructType([train.schema[key], T.StructField("model", T.BinaryType())])
    return train.select(key, order, label, *cols).groupBy(key).applyInPandas(fit, schema)


def predict_boost(rows: DataFrame, feature_cols: Sequence[str], models: DataFrame, key: str = "asset_name") -> DataFrame:
    """``rows`` with ``prediction`` from their asset's model; rows of assets without a model are left out."""
    cols = list(feature_cols)
    schema = T.StructType([*rows.schema.fields, T.StructField("prediction", T.DoubleType())])

    def score(pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(model):
            return pd.DataFrame(columns=schema.names)
        return pdf.assign(prediction=predict_trees(model["model"].iloc[0], _matrix(pdf, cols)))

    return rows.groupBy(key).cogroup(models.select(key, "model").groupBy(key)).applyInPandas(score, schema)


def trial_errors(rows: DataFrame, feature_cols: Sequence[str], trials: dict[int, BoostParams], seed: int = 42,
                 label: str = "target", key: str = "asset_name", order: str = "day", split: str = "split") -> DataFrame:
    """M7: (trial, rmse): each trial fits every asset's 'train' rows and is scored on all 'test' rows.

    The list of trials is configuration; a task fits one trial of one asset.
    """
    from pyspark.sql import functions as F

    cols = list(feature_cols)

    def run(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf[label].notna()].sort_values([order, *cols], kind="stable")
        train, test = pdf[pdf[split] == "train"], pdf[pdf[split] == "test"]
        model = fit_trees(_matrix(train, cols), train[label].to_numpy(float), trials[int(name[1])], seed)
        error = test[label].to_numpy(float) - predict_trees(model, _matrix(test, cols))
        return pd.DataFrame({"trial": [int(name[1])], "sse": [float(error @ error)], "n": [len(error)]})

    every = rows.select(key, order, split, label, *cols).withColumn("trial", F.explode(F.array(*[F.lit(t) for t in trials])))
    parts = every.groupBy(key, "trial").applyInPandas(run, "trial int, sse double, n long")
    return parts.groupBy("trial").agg(F.sqrt(F.try_divide(F.sum("sse"), F.sum("n"))).alias("rmse"))
