"""Champion promotion, thresholds, latest metrics."""

import datetime as dt

from barline.operators import registry as R

RUN_SCHEMA = "run_id long, model_name string, status string, start_time timestamp_ntz, rmse double, mae double"


def _runs(spark, rows):
    return spark.createDataFrame(rows, RUN_SCHEMA)


def _t(d):
    return dt.datetime(2024, 1, d)


def test_promotion_cases(spark):
    runs = _runs(spark, [
        (1, "a", "FINISHED", _t(1), 10.0, 1.0), (2, "a", "FINISHED", _t(2), 5.0, 1.0),   # better → promote
        (3, "b", "FINISHED", _t(1), 10.0, 1.0), (4, "b", "FINISHED", _t(2), 10.0, 1.0),  # equal → keep
        (5, "c", "FINISHED", _t(1), 10.0, 1.0), (6, "c", "FINISHED", _t(2), None, 1.0),  # missing → skip
        (7, "d", "FINISHED", _t(1), 10.0, 1.0),                                           # no champion → promote
        (8, "e", "FINISHED", _t(1), 10.0, 1.0), (9, "e", "FINISHED", _t(2), 1.0, 1.0),   # newest is champ → keep
    ])
    versions = spark.createDataFrame([
        ("a", "1", 1), ("a", "2", 2), ("b", "1", 3), ("b", "2", 4), ("c", "1", 5), ("c", "2", 6),
        ("d", "1", 7), ("e", "9", 8), ("e", "10", 9)], "model_name string, version string, run_id long")
    aliases = spark.createDataFrame([("a", "Champion", "1"), ("b", "Champion", "1"), ("c", "Champion", "1"),
                                     ("e", "Champion", "10")], "model_name string, alias string, version string")
    got = {r["model_name"]: (r["action"], r["champion_after"])
           for r in R.promotion_plan(runs, versions, aliases).collect()}
    assert got == {"a": ("promote", "2"), "b": ("keep", "1"), "c": ("skip", "1"), "d": ("promote", "1"),
                   "e": ("keep", "10")}  # "10" > "9" as integers


def test_latest_metrics_skips_runs_without_rmse(spark):
    runs = _runs(spark, [(1, "a", "FINISHED", _t(1), 3.0, 1.0), (2, "a", "FINISHED", _t(3), None, 1.0),
                         (3, "a", "RUNNING", _t(4), 9.0, 1.0), (4, "a", "FINISHED", _t(2), 4.0, None)])
    r = R.latest_run_metrics(runs).collect()[0]
    assert (r["run_id"], r["rmse"], r["mae"]) == (4, 4.0, None)


def test_latest_metrics_only_last_ten(spark):
    rows = [(i, "a", "FINISHED", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), None if i > 0 else 1.0, 1.0)
            for i in range(12)]
    assert R.latest_run_metrics(_runs(spark, rows)).count() == 0


def test_mae_defaults_when_column_absent(spark):
    runs = _runs(spark, [(1, "a", "FINISHED", _t(1), 3.0, 1.0)]).drop("mae")
    assert R.latest_run_metrics(runs).collect()[0]["mae"] == 0.0


def test_thresholds(spark):
    m = spark.createDataFrame([("a", 25000.0, 1.0), ("b", 1.0, 16000.0), ("c", 1.0, None), ("d", 1.0, float("nan"))],
                              "model_name string, rmse double, mae double")
    got = {r["model_name"]: r["healthy"] for r in R.threshold_check(m).collect()}
    assert got["a"] is False and got["b"] is False and got["c"] is True and got["d"] is True
