"""T-2: live scoring on a stream with keyed state in RocksDB.

Each asset keeps its daily closes in a map from blocks of ``SPAN`` days to the
closes of the block (``transformWithStateInPandas``, one close per calendar
day).  Rows may arrive in any order and in any number of files: a batch loads
only the blocks its days fall into and as many neighbours as the windows of
``look_back`` closes around them reach, writes back only the blocks it changed,
and scores every day whose window changed.  What a batch reads and writes does
not grow with the length of the history.  An earlier score of such a day is
replaced, so the sink holds versions and ``newest_scores`` returns the last one
of each day.  The result does not depend on how the rows were dealt to files or
batches, and no row is dropped.

The score of a day is the stage-1 forecast from the ``look_back`` closes that
end at that day (current row included, as live scoring does), or null while
there are fewer.  A null close keeps its day and gives null scores to the
windows that hold it; rows without a day or without a model are not scored.
Model parameters (scaler and weights) come from a static table joined to the
stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barline.session import state_store

OUTPUT_SCHEMA = T.StructType([
    T.StructField("asset_name", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("version", T.LongType()),
])
SPAN = 64  # days a block of the state covers: a batch that adds one day rewrites one block
EPOCH = np.datetime64("1970-01-01", "D")


class LiveScorer(StatefulProcessor):
    """Per asset: ``blocks`` (block -> its days and closes) and ``extent`` (first and last block, version)."""

    def __init__(self, look_back: int, span: int = SPAN):
        self.look_back, self.span = look_back, span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocks = handle.getMapState("blocks", "block int", "days array<int>, closes array<double>")
        self.extent = handle.getValueState("extent", "first int, last int, version long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        arrived = (pd.to_datetime(new["day"]).to_numpy().astype("datetime64[D]") - EPOCH).astype(int)
        value = new["close"].to_numpy(float)
        order = np.lexsort((value, arrived))  # of several closes of a day in a batch the greatest holds, null last
        touched = sorted(set((arrived // self.span).tolist()))
        first, last, version = self.extent.get() if self.extent.exists() else (touched[0], touched[-1], 0)
        first, last = min(first, touched[0]), max(last, touched[-1])
        loaded: dict[int, dict[int, float]] = {}

        def block(number: int) -> dict[int, float]:
            if number not in loaded:
                held = self.blocks.getValue((number,)) if self.blocks.containsKey((number,)) else ([], [])
                loaded[number] = dict(zip(held[0], [np.nan if c is None else c for c in held[1]]))
            return loaded[number]

        for d, c in zip(arrived[order].tolist(), value[order].tolist()):
            block(d // self.span)[d] = c
        for number in touched:
            days = sorted(loaded[number])
            closes = [loaded[number][d] for d in days]
            self.blocks.updateValue((number,), (days, [None if np.isnan(c) else c for c in closes]))
            for step, end in ((-1, first), (1, last)):
                near, have = number, 0
                while near != end and have < self.look_back - 1:
                    near += step
                    have += len(block(near))
        self.extent.update((first, last, version + 1))
        yield self._scored(key[0], {d: c for b in loaded.values() for d, c in b.items()}, arrived,
                           float(new["x_min"].iloc[0]), float(new["x_max"].iloc[0]),
                           np.asarray(new["weights"].iloc[0], dtype=float), version)

    def _scored(self, asset: str, series: dict[int, float], arrived: np.ndarray, low: float, high: float,
                weights: np.ndarray, version: int) -> pd.DataFrame:
        day = np.array(sorted(series))
        close = np.array([series[d] for d in day.tolist()])
        changed = np.convolve(np.isin(day, arrived), np.ones(self.look_back), "full")[:len(day)] > 0.5
        forecast = np.full(len(day), np.nan)
        if len(day) >= self.look_back:
            scaled = (close - low) / (high - low) if high > low else np.where(np.isnan(close), np.nan, 0.0)
            windows = np.lib.stride_tricks.sliding_window_view(scaled, self.look_back)
            forecast[self.look_back - 1:] = (weights[0] + windows @ weights[1:]) * (high - low) + low
        shown = lambda x: pd.Series(x[changed]).astype(object).where(~np.isnan(x[changed]), None)
        return pd.DataFrame({"asset_name": asset, "day": (EPOCH + day[changed]).astype("datetime64[D]").astype(object),
                             "close": shown(close), "forecast": shown(forecast), "version": int(version)},
                            columns=OUTPUT_SCHEMA.names)


def live_scores(stream: DataFrame, model: DataFrame, look_back: int) -> DataFrame:
    """Streaming scores: ``stream`` (asset_name, day, close) ⋈ ``model``
    (asset_name, x_min, x_max, weights) → (asset_name, day, close, forecast, version)."""
    state_store(stream.sparkSession)
    joined = stream.where(F.col("day").isNotNull()).join(model, "asset_name", "inner").select(
        "asset_name", "day", "close", "x_min", "x_max", "weights")
    return joined.groupBy("asset_name").transformWithStateInPandas(
        LiveScorer(look_back), OUTPUT_SCHEMA, "Append", "None")


def newest_scores(sink: DataFrame) -> DataFrame:
    """The last version of every asset's day."""
    newest = sink.groupBy("asset_name", "day").agg(F.max_by(F.struct("close", "forecast"), "version").alias("s"))
    return newest.select("asset_name", "day", "s.close", "s.forecast")
