"""Session helpers: runtime configuration and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every operator relies on.  They are session-scoped and
# safe to set on an existing session (no static confs here).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Tuning defaults applied only when the session leaves them unset.  The daily
# panels are small per byte but CPU-heavy (window folds), so AQE may keep
# partitions down to 64 KB instead of merging a whole stage into one task;
# large shuffles are unaffected (they coalesce toward the advisory size).
TUNING_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}

# Stateful streams keep their state in RocksDB, off the heap; a batch uploads the
# changes of the state, not the whole of it.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def state_store(spark: SparkSession) -> None:
    """Streams started from here on keep their state in RocksDB (read when a query starts)."""
    for key, value in STATE_STORE_CONF.items():
        spark.conf.set(key, value)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in TUNING_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[8]", app: str = "barline", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Create a local session for tests and the bench (clusters bring their own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder; we never replace it.  Only when it is unset (local tests) do we
    point it at a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="barline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    # the SparkContext may have appended its own uuid folder; write next to it
    base = base.rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"



def materialize(df, name: str, partition_by: tuple[str, ...] = ()):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written table, not
    from raw data) and lets several downstream jobs share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
