"""Typed pipeline configuration (driver side) and the asset dimension.

The configuration is a frozen dataclass tree.  ``Config.from_dict`` accepts the
nested YAML/JSON layout (``assets``, ``training``, ``features``,
``model_params``); missing keys fall back to the defaults below.
"""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureConfig:
    # fixed defaults of the production configuration
    moving_averages: tuple[int, ...] = (3, 7, 14)
    lags: tuple[int, ...] = (1, 2, 3)
    rsi_window: int = 7
    bollinger_window: int = 10
    bollinger_dev: float = 2.0
    volatility_window: int = 7
    macd_slow: int = 12
    macd_fast: int = 6
    macd_signal: int = 3


@dataclass(frozen=True)
class TrainingConfig:
    train_ratio: float = 0.6
    validation_ratio: float = 0.2
    test_ratio: float = 0.2  # declared but never read (as in the source pipeline)
    random_state: int = 42
    forecast_horizon: int = 1  # declared but never read


@dataclass(frozen=True)
class BoostParams:
    n_estimators: int = 100
    learning_rate: float = 0.05
    max_depth: int = 6
    subsample: float = 0.8


@dataclass(frozen=True)
class LookbackParams:
    look_back: int = 10
    units: int = 50
    dropout: float = 0.2
    epochs: int = 20
    batch_size: int = 32
    learning_rate: float = 0.001
    ridge: float = 1e-6  # L2 penalty of the linear look-back regressor


@dataclass(frozen=True)
class Config:
    stocks: tuple[str, ...] = ("AMZN", "IBM", "NVDA")
    cryptos: tuple[str, ...] = ("BTC-USD", "ETH-USD", "SOL-USD")
    training: TrainingConfig = field(default_factory=TrainingConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    boost: BoostParams = field(default_factory=BoostParams)
    lookback: LookbackParams = field(default_factory=LookbackParams)

    @property
    def assets(self) -> tuple[str, ...]:
        return self.stocks + self.cryptos

    @staticmethod
    def from_dict(d: dict) -> "Config":
        assets = d.get("assets", {}) or {}
        feats = d.get("features", {}) or {}
        mp = d.get("model_params", {}) or {}

        def pick(cls, src):
            names = {f.name for f in dataclasses.fields(cls)}
            kw = {}
            for k, v in (src or {}).items():
                if k in names:
                    kw[k] = tuple(v) if isinstance(v, list) else v
            return cls(**kw)

        return Config(
            stocks=tuple(assets.get("stocks", []) or []),
            cryptos=tuple(assets.get("cryptos", []) or []),
            training=pick(TrainingConfig, d.get("training")),
            features=pick(FeatureConfig, feats),
            boost=pick(BoostParams, mp.get("xgboost")),
            lookback=pick(LookbackParams, mp.get("lstm")),
        )

    @staticmethod
    def load(path: str | Path) -> "Config":
        text = Path(path).read_text()
        if str(path).endswith((".yaml", ".yml")):
            import yaml  # optional dependency

            return Config.from_dict(yaml.safe_load(text))
        return Config.from_dict(json.loads(text))


# Tuned-parameter names understood by ``override_params`` and their casts.
PARAM_CASTS = {
    "lstm_units": ("lookback", "units", int),
    "lstm_dropout": ("lookback", "dropout", float),
    "lstm_lr": ("lookback", "learning_rate", float),
    "xgb_n_estimators": ("boost", "n_estimators", int),
    "xgb_max_depth": ("boost", "max_depth", int),
    "xgb_lr": ("boost", "learning_rate", float),
    "xgb_subsample": ("boost", "subsample", float),
}


def override_params(cfg: Config, best: dict) -> Config:
    """Return ``cfg`` with present tuned keys applied (ints cast to int, floats to float)."""
    out = cfg
    for key, (section, name, cast) in PARAM_CASTS.items():
        if key in best and best[key] is not None:
            sec = getattr(out, section)
            out = replace(out, **{section: replace(sec, **{name: cast(best[key])})})
    return out


def save_params(best: dict, path: str | Path) -> None:
    """Write tuned params: floats stay float, everything else becomes int."""
    ser = {k: (float(v) if isinstance(v, float) else int(v)) for k, v in best.items()}
    Path(path).write_text(json.dumps(ser, indent=4))


def load_params(path: str | Path) -> dict:
    p = Path(path)
    return json.loads(p.read_text()) if p.exists() else {}


ASSET_SCHEMA = T.StructType([
    T.StructField("asset_name", T.StringType(), False),
    T.StructField("asset_type", T.StringType(), False),
])


def asset_frame(spark: SparkSession, cfg: Config) -> DataFrame:
    """Configured assets as a two-column dimension (stocks first, then cryptos).

    Its size is bounded by the configuration; the planner picks the join.
    """
    stocks = spark.createDataFrame([(a, "stock") for a in cfg.stocks], ASSET_SCHEMA)
    cryptos = spark.createDataFrame([(a, "crypto") for a in cfg.cryptos], ASSET_SCHEMA)
    return stocks.unionByName(cryptos)
