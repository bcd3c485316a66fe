"""Exact quartiles by distributed selection against Spark's whole-group percentile."""

import math

import pytest
from pyspark.sql import functions as F

from barline.operators import explore as X


def _frame(spark):
    """A hot group with a third of all rows, one hot value, outliers, small and empty groups."""
    n = 30_000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
        .otherwise(F.lit(None)).alias("asset_name"),
        F.when(F.col("id") % 5 == 0, 0.25).when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 13 == 0, float("nan"))
        .when(F.col("id") % 997 == 0, F.lit(1e300)).otherwise(F.exp(F.rand(3) * 40 - 20)).alias("r"))
    few = spark.createDataFrame([("one", 2.0), ("two", 1.0), ("two", 4.0), ("none", None), ("nan", math.nan),
                                 ("signs", -0.0), ("signs", 0.0), ("signs", -5.0)], "asset_name string, r double")
    return base.unionByName(few)


@pytest.mark.parametrize("levels", [1, 4, 10])
def test_quartiles_equal_percentile(spark, levels):
    df = _frame(spark)
    v = F.nullif(F.col("r"), F.lit(float("nan")))
    want = {r["asset_name"]: r for r in df.groupBy("asset_name").agg(
        F.percentile(v, F.lit([0.0, 0.25, 0.5, 0.75, 1.0])).alias("q"), F.count(v).alias("n")).collect()}
    got = X.distribution(df, "r", levels=levels).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r["asset_name"]]
        assert [r[c] for c in ("p0", "p25", "p50", "p75", "p100")] == (list(w["q"]) if w["q"] else [None] * 5)
        assert r["n"] == w["n"]


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "asset_name string, r double")
    assert X.distribution(empty, "r").count() == 0
    df = spark.createDataFrame([("A", 1.0, 7, 9), ("A", 3.0, 7, 9)], "n string, mean double, _v int, _cell int")
    assert X.distribution(df, "mean", ["n"]).toPandas().iloc[0, 1:6].tolist() == [1.0, 1.5, 2.0, 2.5, 3.0]

