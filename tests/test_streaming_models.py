"""Streaming operators and model jobs on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from barline.operators import models as MD
from barline.plans import catalog as C


def test_stream_daily_close_covers_every_day(spark):
    from barline.sources.tables import read_table

    out = C.QUERIES["stream_daily_close"](spark, SF001)
    assert out.columns == ["asset_name", "day", "close"]
    days = read_table(spark, SF001, "events").select("event_type", F.to_date("ts")).distinct()
    assert out.count() == out.select("asset_name", "day").distinct().count() == days.count()


@pytest.mark.parametrize("files", [1, 2, 64])
def test_live_scores_do_not_depend_on_files_or_order(spark, tmp_path, files):
    import numpy as np

    from barline.streaming import daily_close as SD
    from barline.streaming import live_score as SL

    rng = np.random.default_rng(4)
    close = rng.normal(100, 5, 120)
    where = rng.integers(0, 6, 120)
    for k in range(6):
        rows = [("A", int(i), float(close[i])) for i in np.flatnonzero(where == k)]
        spark.createDataFrame(rows, "asset_name string, i int, close double").select(
            "asset_name", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("day"), "close").coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "feed"))
    model = spark.createDataFrame([("A", 80.0, 120.0, [0.1, 0.2, 0.3, 0.4])],
                                  "asset_name string, x_min double, x_max double, weights array<double>")
    stream = spark.readStream.schema(C.FEED_SCHEMA).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "feed"))
    got = SL.newest_scores(SD.run_to_table(spark, SL.live_scores(stream, model, 3), "test-live")).orderBy("day").collect()
    assert len(got) == 120 and [r["close"] for r in got] == pytest.approx(close.tolist())
    x = (close - 80) / 40
    for i, r in enumerate(got):
        want = None if i < 2 else (0.1 + x[i - 2] * 0.2 + x[i - 1] * 0.3 + x[i] * 0.4) * 40 + 80
        assert r["forecast"] == (want if want is None else pytest.approx(want))


def test_live_scores_span_gaps_blocks_and_null_closes(spark, tmp_path):
    """Days far apart, late days before the first one, a null close and a null day, one row a batch."""
    from barline.streaming import daily_close as SD
    from barline.streaming import live_score as SL

    feed = [(500, 100.0), (10, 90.0), (501, 101.0), (0, 85.0), (200, None), (64, 95.0), (63, 94.0), (None, 1.0), (502, 99.0)]
    for i, c in feed:
        spark.createDataFrame([("A", i, c), ("no model", i, c)], "asset_name string, i int, close double").select(
            "asset_name", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("day"), "close").coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "feed"))
    model = spark.createDataFrame([("A", 80.0, 120.0, [0.1, 0.2, 0.3])],
                                  "asset_name string, x_min double, x_max double, weights array<double>")
    stream = spark.readStream.schema(C.FEED_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    got = SL.newest_scores(SD.run_to_table(spark, SL.live_scores(stream, model, 2), "test-gaps")).orderBy("day").collect()
    series = [c for i, c in sorted((i, c) for i, c in feed if i is not None)]
    assert [r["close"] for r in got] == series
    for k, r in enumerate(got):
        pair = series[k - 1:k + 1] if k else [None]
        want = None if None in pair else (0.1 + (pair[0] - 80) / 40 * 0.2 + (pair[1] - 80) / 40 * 0.3) * 40 + 80
        assert r["forecast"] == (want if want is None else pytest.approx(want))


def test_live_state_written_does_not_grow_with_history(spark, tmp_path):
    """One more day writes the same state rows and scores the same days after 100 days as after 3,000."""
    from barline.session import scratch_path
    from barline.streaming import live_score as SL

    model = spark.createDataFrame([("A", 0.0, 1.0, [0.0, 0.5, 0.5])],
                                  "asset_name string, x_min double, x_max double, weights array<double>")
    written = []
    for history in (100, 3000):
        feed, root = str(tmp_path / f"feed{history}"), scratch_path(spark, "test-state")

        def run(low, high):
            spark.range(low, high, 1, 1).select(
                F.lit("A").alias("asset_name"), F.date_add(F.lit("2010-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
                (F.col("id") / 3000).alias("close")).write.mode("append").parquet(feed)
            scores = SL.live_scores(spark.readStream.schema(C.FEED_SCHEMA).parquet(feed), model, 2)
            query = scores.writeStream.format("parquet").option("path", f"{root}/out").option(
                "checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
            assert query.exception() is None
            state = [p for p in query.recentProgress if p["numInputRows"]][-1]["stateOperators"][0]
            return state["numRowsUpdated"]

        run(0, history)
        before = spark.read.parquet(f"{root}/out").count()
        written.append((run(history, history + 1), spark.read.parquet(f"{root}/out").count() - before))
    assert written[0] == written[1] and written[0][1] == 1


def test_stream_live_score_forecasts(spark):
    out = C.QUERIES["stream_live_score"](spark, SF001)
    assert out.count() == C._daily(spark, SF001).count()
    assert out.where(F.col("forecast").isNotNull()).count() > 0


def test_ridge_l1_equals_ols(spark):
    rows = [("A", [float(i)], 2.0 * i + 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "asset_name string, seq array<double>, y double")
    w = MD.fit_lookback(df, 1, 0.0).collect()[0]["weights"]
    assert w == pytest.approx([1.0, 2.0])


def test_lookback_predict_expression(spark):
    df = spark.createDataFrame([([1.0, 2.0], [0.5, 1.0, 2.0])], "seq array<double>, weights array<double>")
    assert df.select(MD.lookback_predict(F.col("seq"), F.col("weights"), 2)).collect()[0][0] == pytest.approx(5.5)


def test_next_forecast_l1(spark):
    out = C.QUERIES["next_forecast_l1"](spark, SF001).collect()
    assert len(out) == 5
    for r in out:
        assert r["forecast_price"] is not None and r["current_price"] > 0


def test_best_params_json_roundtrip_and_override(spark, tmp_path):
    from barline.config import Config
    from barline.plans import training as TR

    trials = spark.createDataFrame(
        [(0, 55, 0.2, 0.001, 244, 3, 0.18, 0.77, 1.0, False), (1, 60, 0.3, 0.002, 100, 7, 0.1, 0.9, 0.5, True)],
        "trial int, lstm_units long, lstm_dropout double, lstm_lr double, xgb_n_estimators long, "
        "xgb_max_depth long, xgb_lr double, xgb_subsample double, rmse double, best boolean")
    path = str(tmp_path / "best")
    TR.save_best_params(trials, path)
    back = TR.load_best_params(spark, path).collect()
    assert len(back) == 1 and back[0]["xgb_max_depth"] == 7 and back[0]["lstm_units"] == 60
    eff = TR.effective_params(TR.load_best_params(spark, path), Config()).collect()[0]
    assert eff["boost_max_depth"] == 7 and eff["boost_learning_rate"] == 0.1 and eff["lookback_units"] == 60
    missing = TR.load_best_params(spark, str(tmp_path / "none"))
    assert missing.count() == 0


def test_draw_trials_seeded_and_in_range():
    from barline.plans.training import SEARCH_SPACE, draw_trials

    a, b = draw_trials(10, 42), draw_trials(10, 42)
    assert a == b and len(a) == 10
    for t in a:
        for name, (lo, hi, _) in SEARCH_SPACE.items():
            assert lo <= t[name] <= hi


def test_ridge_matches_numpy_closed_form(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 3))
    y = 0.5 + x @ np.array([1.0, -2.0, 0.25]) + rng.normal(scale=0.1, size=40)
    rows = [("A", [float(v) for v in xi], float(yi)) for xi, yi in zip(x, y)]
    df = spark.createDataFrame(rows, "asset_name string, seq array<double>, y double")
    lam = 0.3
    got = np.array(MD.fit_lookback(df, 3, lam).collect()[0]["weights"])
    z = np.hstack([np.ones((40, 1)), x])
    pen = lam * np.eye(4)
    pen[0, 0] = 0.0
    want = np.linalg.solve(z.T @ z + pen, z.T @ y)
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9)


def _boost_rows(spark, assets: int):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(assets * 40, 2))
    rows = [(f"A{i % assets:02d}", i // assets, float(a), float(b), float((i % assets) * 100 + 10 * a + (b > 0)))
            for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "asset_name string, day long, f1 double, f2 double, target double")


def test_boosted_trees_for_forty_assets(spark):
    from barline.config import BoostParams
    from barline.operators import boosting as B

    rows = _boost_rows(spark, 40)
    params = BoostParams(n_estimators=30, learning_rate=0.2, max_depth=3)
    models = B.fit_boost(rows, ["f1", "f2"], params)
    assert models.count() == 40
    got = B.predict_boost(rows, ["f1", "f2"], models).selectExpr("avg(abs(prediction - target)) AS e", "count(*) AS n").first()
    assert got["n"] == 1600 and got["e"] < 2.5


def test_boosted_trees_do_not_depend_on_partitions(spark):
    from barline.config import BoostParams
    from barline.operators import boosting as B

    rows, params = _boost_rows(spark, 3), BoostParams(n_estimators=10, subsample=0.8)
    one, four = ({r["asset_name"]: r["model"] for r in B.fit_boost(rows.repartition(k), ["f1", "f2"], params).collect()}
                 for k in (1, 4))
    assert one == four


def test_boosted_trees_missing_values_and_empty_groups():
    import numpy as np

    from barline.config import BoostParams
    from barline.operators import boosting as B

    x = np.array([[1.0, np.nan], [2.0, np.nan], [3.0, 1.0], [np.nan, 2.0]])
    model = B.fit_trees(x, np.array([1.0, 1.0, 5.0, 5.0]), BoostParams(n_estimators=50, learning_rate=0.5, subsample=1.0), 1)
    assert np.allclose(B.predict_trees(model, x)[:3], [1, 1, 5], atol=0.6)
    none = B.fit_trees(np.zeros((0, 2)), np.zeros(0), BoostParams(), 1)
    assert (B.predict_trees(none, x) == 0).all()
