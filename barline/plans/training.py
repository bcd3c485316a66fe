"""Two-stage training flow over all assets at once (M3), scoring (M4/M5) and
forecast records (M6), hyper-parameter search (M7), model store (S10).

Flow: feature table → min-max scale per asset → look-back sequences →
chronological split → stage-1 fit on train → stage-1 predictions (un-scaled)
on val/test → stage 2 trained on val, evaluated on test → forecast from the
last L closes (current row included).
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.config import BoostParams, Config
from barline.operators import boosting as B
from barline.operators import metrics as M
from barline.operators import models as MD
from barline.operators import sequences as SQ
from barline.session import materialize, scratch_path


@dataclass
class Stage1:
    scaled: DataFrame  # feature rows + x_min, x_max, scaled
    seqs: DataFrame    # scaled rows with seq, seq_idx, y, split
    weights: DataFrame  # asset_name, weights, n


def stage1(features: DataFrame, cfg: Config, look_back: int | None = None, ridge: float | None = None) -> Stage1:
    L = look_back or cfg.lookback.look_back
    lam = cfg.lookback.ridge if ridge is None else ridge
    scaled = SQ.minmax_fit(features)
    scaled = scaled.withColumn("scaled", SQ.scale(F.col("close"), F.col("x_min"), F.col("x_max")))
    seqs = SQ.lookback(scaled, L).withColumn("y", F.col("scaled"))
    t = cfg.training
    seqs = SQ.chrono_split(seqs, (t.train_ratio, t.validation_ratio))
    weights = MD.fit_lookback(seqs.where(F.col("split") == "train"), L, lam)
    return Stage1(scaled, seqs, weights)


def with_stage1_pred(seqs: DataFrame, weights: DataFrame, look_back: int) -> DataFrame:
    """Attach the un-scaled stage-1 prediction ``lstm_pred`` (J1: joined on the asset key)."""
    j = seqs.join(weights.select("asset_name", "weights"), "asset_name", "inner")
    pred = MD.lookback_predict(F.col("seq"), F.col("weights"), look_back)
    return j.withColumn("lstm_pred", SQ.unscale(pred, F.col("x_min"), F.col("x_max")))


AUX = ("x_min", "x_max", "scaled", "seq", "seq_idx", "y", "split", "weights", "day")


def stack_features(stacked: DataFrame) -> list[str]:
    """Stage-2 inputs = all feature columns except target/keys/close, plus lstm_pred."""
    return [c for c in SQ.feature_columns(stacked) if c not in AUX]


def train_stacked(features: DataFrame, cfg: Config, seed: int = 42):
    """M2/M3: returns (stage1, stacked rows, feature columns, stage-2 models per asset).

    The feature table and the models are written once to the shared checkpoint
    folder; everything else reads them.
    """
    features = materialize(features, "train-features")
    s1 = stage1(features, cfg)
    stacked = with_stage1_pred(s1.seqs.where(F.col("split") != "train"), s1.weights, cfg.lookback.look_back)
    cols = stack_features(stacked)
    models = materialize(B.fit_boost(stacked.where(F.col("split") == "val"), cols, cfg.boost, seed), "stage2-models")
    return s1, stacked, cols, models


def test_metrics(stacked: DataFrame, cols: list[str], models: DataFrame) -> DataFrame:
    """Stage-2 metrics on the test part per asset (RMSE, MAE, MAPE, MinMax RMSE, DA)."""
    scored = B.predict_boost(stacked.where(F.col("split") == "test").select("asset_name", "day", "target", *cols), cols, models)
    scored = scored.select("asset_name", "day", F.col("target").alias("y_true"), F.col("prediction").alias("y_pred"))
    return M.evaluate(scored, ["asset_name"], None, ["day"])


def live_rows(s1: Stage1, look_back: int) -> DataFrame:
    """M5: last row per asset with the stage-1 prediction from its last L closes (current included)."""
    live = SQ.lookback(s1.scaled, look_back, include_current=True)
    live = MD.last_row(live)
    return with_stage1_pred(live, s1.weights, look_back)


def forecast_records(live_scored: DataFrame, price: str = "close", forecast: str = "prediction") -> DataFrame:
    """Asset, last_date, current_price, forecast_price, predicted_change_pct."""
    return live_scored.select(
        "asset_name", F.col("day").alias("last_date"), F.col(price).alias("current_price"),
        F.col(forecast).alias("forecast_price"),
        (F.try_divide(F.col(forecast) - F.col(price), F.col(price)) * F.lit(100.0)).alias("predicted_change_pct"))


# ------------------------------------------------------------- search ----
# fixed search ranges of the source tuner (name: (low, high, kind))
SEARCH_SPACE = {
    "lstm_units": (20, 100, "int"),
    "lstm_dropout": (0.1, 0.5, "float"),
    "lstm_lr": (1e-4, 1e-2, "log"),
    "xgb_n_estimators": (50, 300, "int"),
    "xgb_max_depth": (3, 10, "int"),
    "xgb_lr": (0.01, 0.3, "float"),
    "xgb_subsample": (0.5, 1.0, "float"),
}


def draw_trials(n_trials: int, seed: int = 42) -> list[dict]:
    """Seeded random search draws (the trial table is configuration-sized)."""
    import math

    rng = random.Random(seed)
    out = []
    for t in range(n_trials):
        p = {"trial": t}
        for name, (lo, hi, kind) in SEARCH_SPACE.items():
            if kind == "int":
                p[name] = rng.randint(lo, hi)
            elif kind == "log":
                p[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                p[name] = rng.uniform(lo, hi)
        out.append(p)
    return out


def hyperparam_search(features: DataFrame, cfg: Config, n_trials: int = 10, seed: int = 42) -> DataFrame:
    """M7: random search; each trial fits stage 2 on the first 80 % of the stacked rows
    (chronological, per asset) and is scored by RMSE on the last 20 %.

    Stage 1 is fitted once: its ridge model has no trial parameters, so the
    drawn ``lstm_*`` values change nothing, which ``without_effect`` says.  All
    trials of all assets run as one grouped job; of equal errors the first
    trial is the best.
    """
    s1 = stage1(materialize(features, "search-features"), cfg)
    stacked = with_stage1_pred(s1.seqs, s1.weights, cfg.lookback.look_back)
    stacked = SQ.chrono_split(stacked.drop("split"), (0.8,), min_rows=2)
    cols = stack_features(stacked)
    trials = draw_trials(n_trials, seed)
    params = {t["trial"]: BoostParams(int(t["xgb_n_estimators"]), float(t["xgb_lr"]), int(t["xgb_max_depth"]),
                                      float(t["xgb_subsample"])) for t in trials}
    errors = materialize(B.trial_errors(stacked, cols, params, seed), "search-errors")
    best = errors.agg(F.min_by("trial", F.struct("rmse", "trial"))).scalar()
    drawn = F.array(*[F.struct(*[F.lit(t[k]).alias(k) for k in SEARCH_SPACE]) for t in trials])
    rows = errors.select("trial", F.get(drawn, F.col("trial")).alias("p"), "rmse", (F.col("trial") == best).alias("best"))
    return rows.select("trial", "p.*", "rmse", "best", F.lit("lstm_units, lstm_dropout, lstm_lr").alias("without_effect"))


def save_best_params(trials: DataFrame, path: str) -> None:
    """The best trial's parameters as a JSON table (floats stay float, counts int)."""
    cols = []
    for name, (_, _, kind) in SEARCH_SPACE.items():
        cols.append(F.col(name).cast("long" if kind == "int" else "double").alias(name))
    trials.where("best").orderBy("rmse", "trial").limit(1).select(*cols).coalesce(1).write.mode("overwrite").json(path)


def load_best_params(spark: SparkSession, path: str) -> DataFrame:
    """Read the tuned parameters back (explicit schema; a missing file gives no rows)."""
    from pyspark.sql import types as T

    from barline.sources.files import _exists

    schema = T.StructType([T.StructField(n, T.LongType() if k == "int" else T.DoubleType())
                           for n, (_, _, k) in SEARCH_SPACE.items()])
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def effective_params(best_params: DataFrame, cfg: Config) -> DataFrame:
    """P17 table form: defaults overridden by the tuned values (ints cast to int, floats to float).

    ``best_params`` holds at most one row (the best trial, or the JSON of S6).
    """
    from barline.config import PARAM_CASTS

    best = best_params.limit(1)
    cols = []
    for key, (section, name, cast) in PARAM_CASTS.items():
        default = getattr(getattr(cfg, section), name)
        typ = "long" if cast is int else "double"
        cols.append(F.coalesce(F.col(key).cast(typ), F.lit(default).cast(typ)).alias(f"{section}_{name}"))
    return best.select(*cols)


def save_models(spark: SparkSession, weights: DataFrame, models: DataFrame, name: str) -> str:
    """Stage-1 weights and stage-2 models as Parquet under one folder of the
    shared checkpoint directory; returns the folder."""
    root = scratch_path(spark, f"models-{name}")
    weights.write.mode("overwrite").parquet(f"{root}/stage1")
    models.write.mode("overwrite").parquet(f"{root}/stage2")
    return root


def load_models(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{root}/stage1"), spark.read.parquet(f"{root}/stage2")
