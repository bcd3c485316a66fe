"""A versioned table of stage-1 models, loaded through the alias table.

The table is partitioned by (model_name, version): one folder a version, as a
registry keeps its artifacts.  Loading joins the aliases to the partition
columns, so dynamic partition pruning opens only the folders that an alias
names, however many versions there are.  A model that cannot be loaded is a row
with its ``failure``; the others load all the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.operators.registry import CHAMPION
from barline.sources.files import read_parquet

PARTITIONS = ("model_name", "version")
STORE_SCHEMA = T.StructType([
    T.StructField("asset_name", T.StringType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
    T.StructField("x_min", T.DoubleType()),
    T.StructField("x_max", T.DoubleType()),
    T.StructField("n", T.LongType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("version", T.StringType()),
])
NO_ALIAS, NOT_STORED, UNREADABLE = "no alias", "version not stored", "unreadable weights"


def save_versions(models: DataFrame, root: str) -> None:
    """Write model versions; a version written again replaces its folder, others stay.

    A row without name or version lies in the default folder, which no alias names.
    """
    models.select(*STORE_SCHEMA.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *PARTITIONS).parquet(root)


def stored_versions(spark: SparkSession, root: str) -> DataFrame:
    """The model table; a missing folder is a table without rows."""
    return read_parquet(spark, root, STORE_SCHEMA)


def _unreadable(weights: Column) -> Column:
    bad = F.exists(weights, lambda w: w.isNull() | F.isnan(w) | (F.abs(w) == float("inf")))
    return weights.isNull() | (F.size(weights) < 2) | F.coalesce(bad, F.lit(True))


def load_by_alias(models: DataFrame, aliases: DataFrame, store: DataFrame, alias: str = CHAMPION) -> DataFrame:
    """One row per distinct ``model_name`` of ``models``: version, failure (null when loaded) and the stored columns.

    ``aliases`` has (model_name, alias, version); of repeated rows the greatest
    version number holds.  Failures: no alias, a version that is not stored,
    weights that are missing, too few or not finite (these come back null).
    """
    chosen = aliases.where(F.col("alias") == alias).groupBy("model_name").agg(
        F.max_by("version", F.coalesce(F.col("version").try_cast("long"), F.lit(-1))).alias("version"))
    found = store.join(chosen, list(PARTITIONS)).withColumn("_stored", F.lit(True))
    wanted = models.select("model_name").distinct().join(chosen, "model_name", "left")
    out = wanted.join(found, list(PARTITIONS), "left")
    failure = F.when(F.col("version").isNull(), NO_ALIAS).when(F.col("_stored").isNull(), NOT_STORED).when(
        _unreadable(F.col("weights")), UNREADABLE)
    kept = [c for c in STORE_SCHEMA.names if c not in PARTITIONS]
    return out.withColumn("failure", failure).select(
        *PARTITIONS, "failure", *[F.when(F.col("failure").isNull(), F.col(c)).alias(c) for c in kept])
