"""Model-registry and run-table operators (tables instead of a tracking server).

Tables: ``runs(run_id, model_name, status, start_time, <metric columns>)``,
``versions(model_name, version text, run_id)``, ``aliases(model_name, alias, version)``.
Per-model results are computed for all models in one job.  Large tables
(runs, versions) are only ever reduced by partial aggregation or top-k before
they meet the small per-model frames; AQE turns those joins into broadcasts
at run time once the small side's real size is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.names import model_base_col, registry_name_col
from barline.operators.sequential import top_k_per_group

# fixed thresholds of the performance monitor
RMSE_LIMIT = 20000.0
MAE_LIMIT = 15000.0
CHAMPION = "Champion"
RECENT_RUNS = 10


def _newest_first(runs: DataFrame):
    return [F.col("start_time").desc(), F.col("run_id").desc()]


def latest_run_metrics(runs: DataFrame, metric: str = "rmse", recent: int = RECENT_RUNS) -> DataFrame:
    """Per model, among the newest ``recent`` finished runs the first with ``metric``.

    ``mae`` defaults to 0.0 only when the column is absent from the table.
    """
    finished = runs.where(F.col("status") == "FINISHED")
    top = top_k_per_group(finished, ["model_name"], _newest_first(runs), recent, "_rank")
    mae = F.col("mae") if "mae" in runs.columns else F.lit(0.0)
    cand = top.where(F.col(metric).isNotNull()).select(
        "model_name", "_rank", F.struct(F.col("run_id"), F.col(metric).alias("rmse"), mae.alias("mae")).alias("_r"))
    best = cand.groupBy("model_name").agg(F.min_by("_r", "_rank").alias("_r"))
    return best.select("model_name", "_r.run_id", "_r.rmse", "_r.mae")


def threshold_check(metrics: DataFrame, rmse_limit: float = RMSE_LIMIT, mae_limit: float = MAE_LIMIT) -> DataFrame:
    """Unhealthy when rmse > limit or mae > limit; a missing value never exceeds.

    NaN is treated as missing (Spark orders NaN above every number, so a bare
    ``NaN > limit`` would be true).
    """
    def missing_as_null(c: str):
        return F.when(~F.isnan(F.col(c)), F.col(c))

    rmse_ok = ~F.coalesce(missing_as_null("rmse") > F.lit(rmse_limit), F.lit(False))
    mae_ok = ~F.coalesce(missing_as_null("mae") > F.lit(mae_limit), F.lit(False))
    return metrics.withColumns({"rmse_ok": rmse_ok, "mae_ok": mae_ok, "healthy": rmse_ok & mae_ok})


def run_metrics_view(runs: DataFrame, metric_cols: list[str]) -> DataFrame:
    """Metrics of each model's newest finished run as (metric, value) rows, nulls dropped;
    a run without any metric gives one 'available' row, a model without a finished run one 'unavailable' row."""
    finished = runs.where(F.col("status") == "FINISHED")
    newest = top_k_per_group(finished, ["model_name"], _newest_first(runs), 1, "_rank")
    long = newest.select("model_name", "run_id", *metric_cols).unpivot(
        ["model_name", "run_id"], metric_cols, "metric", "value").where(F.col("value").isNotNull())
    models = runs.select("model_name").distinct()
    avail = long.withColumn("status", F.lit("available"))
    missing = models.join(newest.select("model_name"), "model_name", "left_anti").select(
        "model_name", F.lit(None).cast("long").alias("run_id"), F.lit(None).cast("string").alias("metric"),
        F.lit(None).cast("double").alias("value"), F.lit("unavailable").alias("status"))
    bare = newest.where(F.coalesce(*[F.col(c).cast("double") for c in metric_cols]).isNull()).select(
        "model_name", "run_id", F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"),
        F.lit("available").alias("status"))
    return avail.unionByName(bare).unionByName(missing)


def newest_versions(versions: DataFrame) -> DataFrame:
    """O2: newest version per model, versions compared as integers.

    Registry versions are integer text, so the newest one is written back from
    the integer maximum; with only long-typed buffers both aggregation phases
    are hash aggregates (a string ``max_by`` buffer forces a sort of every row).
    """
    v = F.col("version").cast("long")
    return versions.groupBy("model_name").agg(
        F.max(v).cast("string").alias("newest_version"), F.max_by("run_id", v).alias("newest_run_id"))


def champions(aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """Current champion version and its run per model."""
    champ = aliases.where(F.col("alias") == CHAMPION).select("model_name", F.col("version").alias("champion_version"))
    return champ.join(
        versions.select("model_name", F.col("version").alias("champion_version"), F.col("run_id").alias("champion_run_id")),
        ["model_name", "champion_version"], "left")


def promotion_plan(runs: DataFrame, versions: DataFrame, aliases: DataFrame, metric: str = "rmse",
                   lower_is_better: bool = True) -> DataFrame:
    """M9: per model the promotion decision.

    no champion → promote newest; newest already champion → keep; a metric
    missing on either run → skip; strictly better → promote; otherwise keep.
    """
    v = F.col("version").cast("long")
    champ = aliases.where(F.col("alias") == CHAMPION).select("model_name", F.col("version").cast("long").alias("_champion"))
    # one pass over the versions: newest and champion run of each model (integer buffers keep it a hash aggregate)
    plan = versions.join(champ, "model_name", "left").groupBy("model_name").agg(
        F.max(v).cast("string").alias("newest_version"), F.max_by("run_id", v).alias("newest_run_id"),
        F.max("_champion").cast("string").alias("champion_version"),
        F.max(F.when(v == F.col("_champion"), F.col("run_id"))).alias("champion_run_id"))
    # one pass over the runs: both runs of a model, then a pivot to one row
    wanted = plan.select("model_name", "newest_version", "champion_version", F.explode(F.array(
        F.struct(F.lit(True).alias("newest"), F.col("newest_run_id").alias("run_id")),
        F.struct(F.lit(False).alias("newest"), F.col("champion_run_id").alias("run_id")))).alias("_r")).select(
        "model_name", "newest_version", "champion_version", "_r.newest", "_r.run_id")
    m = wanted.join(runs.select("run_id", F.col(metric).alias("_m")), "run_id", "left")
    plan = m.groupBy("model_name", "newest_version", "champion_version").agg(
        F.max(F.when(F.col("newest"), F.col("_m"))).alias("new_metric"),
        F.max(F.when(~F.col("newest"), F.col("_m"))).alias("champion_metric"))
    better = (F.col("new_metric") < F.col("champion_metric")) if lower_is_better else (
        F.col("new_metric") > F.col("champion_metric"))
    action = (
        F.when(F.col("champion_version").isNull(), "promote")
        .when(F.col("newest_version") == F.col("champion_version"), "keep")
        .when(F.col("new_metric").isNull() | F.col("champion_metric").isNull(), "skip")
        .when(better, "promote")
        .otherwise("keep")
    )
    plan = plan.withColumn("action", action)
    after = F.when(F.col("action") == "promote", F.col("newest_version")).otherwise(F.col("champion_version"))
    return plan.select("model_name", "newest_version", "champion_version", "new_metric", "champion_metric",
                       "action", after.alias("champion_after"))


def champion_status(models: DataFrame, aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """Champion version and run per configured model, 'none' when there is none."""
    c = champions(aliases, versions)
    out = models.join(c, "model_name", "left")
    return out.withColumn("status", F.when(F.col("champion_version").isNull(), "none").otherwise("ok"))


def registry_listing(versions: DataFrame, aliases: DataFrame, prefix: str) -> DataFrame:
    """Every version of the models whose name starts with ``prefix`` and its sorted aliases."""
    tags = aliases.groupBy("model_name", "version").agg(
        F.array_join(F.sort_array(F.collect_set("alias")), ",").alias("aliases"))
    v = versions.where(F.col("model_name").startswith(prefix))
    return v.join(tags, ["model_name", "version"], "left").select(
        "model_name", "version", "run_id", F.coalesce("aliases", F.lit("")).alias("aliases"))


def model_info(assets: DataFrame, loaded: DataFrame) -> DataFrame:
    """Per configured asset: loaded flag, registry name; plus total loaded."""
    flag = loaded.select("asset_name").distinct().withColumn("model_loaded", F.lit(True))
    out = assets.join(flag, "asset_name", "left").select(
        "asset_name", F.coalesce("model_loaded", F.lit(False)).alias("model_loaded"),
        registry_name_col(model_base_col(F.col("asset_name"))).alias("registry_name"))
    # the frame is bounded by the configured asset list, so one window partition is fine
    return out.withColumn("total_loaded", F.count_if("model_loaded").over(Window.partitionBy()))
