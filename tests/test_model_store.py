"""Versioned model table: load by alias, failures as rows, partition pruning."""

import math

from barline.operators import model_store as MS
from barline.session import materialize, scratch_path


def _models(spark, rows):
    return spark.createDataFrame([(f"a{m}", w, 0.0, 1.0, 5, m, v) for m, v, w in rows], MS.STORE_SCHEMA)


def _aliases(spark, rows):
    return materialize(spark.createDataFrame(rows, "model_name string, alias string, version string"), "test-aliases")


def test_load_by_alias_reports_each_failure(spark):
    root = scratch_path(spark, "test-store")
    MS.save_versions(_models(spark, [("m x/1", "1", [0.0, 1.0]), ("m x/1", "2", [0.5, 2.0]), ("nan", "1", [0.0, math.nan]),
                                     ("null", "1", None), ("short", "1", [1.0]), ("gone", "1", [0.0, 1.0])]), root)
    aliases = _aliases(spark, [("m x/1", "Champion", "2"), ("m x/1", "Champion", "1"), ("m x/1", "Other", "9"),
                               ("nan", "Champion", "1"), ("null", "Champion", "1"), ("short", "Champion", "1"),
                               ("gone", "Champion", "7"), ("other alias", "Challenger", "1")])
    names = spark.createDataFrame([(n,) for n in ("m x/1", "m x/1", "nan", "null", "short", "gone", "other alias", None)], "model_name string")
    got = {r["model_name"]: r for r in MS.load_by_alias(names, aliases, MS.stored_versions(spark, root)).collect()}
    assert {k: r["failure"] for k, r in got.items()} == {
        "m x/1": None, "nan": MS.UNREADABLE, "null": MS.UNREADABLE, "short": MS.UNREADABLE, "gone": MS.NOT_STORED,
        "other alias": MS.NO_ALIAS, None: MS.NO_ALIAS}
    assert (got["m x/1"]["version"], got["m x/1"]["weights"], got["m x/1"]["asset_name"]) == ("2", [0.5, 2.0], "am x/1")
    assert got["nan"]["weights"] is None and got["gone"]["version"] == "7"


def test_a_version_written_again_replaces_itself_alone(spark):
    root = scratch_path(spark, "test-store")
    MS.save_versions(_models(spark, [("m", "1", [0.0, 1.0]), ("m", "2", [0.0, 2.0])]), root)
    MS.save_versions(_models(spark, [("m", "2", [0.0, 3.0])]), root)
    got = MS.stored_versions(spark, root).orderBy("version").collect()
    assert [(r["version"], r["weights"][1]) for r in got] == [("1", 1.0), ("2", 3.0)]


def test_only_folders_an_alias_names_are_read(spark):
    root = scratch_path(spark, "test-store")
    MS.save_versions(_models(spark, [(f"m{i}", str(v), [0.0, 1.0]) for i in range(3) for v in range(4)]), root)
    aliases = _aliases(spark, [("m1", "Champion", "2")])
    names = spark.createDataFrame([("m1",)], "model_name string")
    out = MS.load_by_alias(names, aliases, MS.stored_versions(spark, root))
    assert out.count() == 1
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()


def test_missing_store_and_empty_tables(spark):
    store = MS.stored_versions(spark, scratch_path(spark, "test-none"))
    names = spark.createDataFrame([("m",)], "model_name string")
    got = MS.load_by_alias(names, _aliases(spark, [("m", "Champion", "1")]), store).collect()
    assert [r["failure"] for r in got] == [MS.NOT_STORED]
    assert MS.load_by_alias(names.limit(0), _aliases(spark, []), store).count() == 0
