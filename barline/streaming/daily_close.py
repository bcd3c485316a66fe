"""T-1: daily close on a stream — event-time windows with a watermark.

``max_by(price, struct(ts, tie))`` per (asset, 1-day window).  The watermark
bounds the state; the query runs in update mode, so days that are still open
are written too, and a day written again replaces its earlier value:
``run_updates`` keeps the last batch's value of each key.  The result covers
every day that the stream has seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.session import scratch_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def daily_close(stream: DataFrame, key: str = "asset_name", ts: str = "ts", value: str = "price",
                tie: str = "tie", watermark: str = "1 hour") -> DataFrame:
    """Streaming (key, day, close); ``ts`` must be a TIMESTAMP column."""
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(F.col(key), F.window(F.col(ts), "1 day"))
        .agg(F.max_by(value, F.struct(ts, tie)).alias("close"))
        .select(key, F.to_date(F.col("window.start")).alias("day"), "close")
    )


def file_stream(spark: SparkSession, path_glob: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path_glob)


def run_to_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run an appending stream over everything available (``availableNow``) into a
    Parquet sink in the shared checkpoint folder; return the sink as a batch frame."""
    root = scratch_path(spark, f"stream-{name}")
    _finish(df.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out"), root)
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def run_updates(spark: SparkSession, df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an updating stream over everything available; return the newest row of each key.

    Each micro-batch writes its changed rows to its own folder, overwriting it
    when the batch is repeated after a failure.
    """
    root = scratch_path(spark, f"stream-{name}")

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    _finish(df.writeStream.outputMode("update").foreachBatch(write), root)
    schema = T.StructType([*df.schema.fields, T.StructField("_batch", T.LongType())])
    rest = [c for c in df.columns if c not in keys]
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/out")
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_s"))
    return newest.select(*[F.col(f"_s.{c}") if c in rest else F.col(c) for c in df.columns])


def _finish(writer, root: str) -> None:
    query = writer.option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def events_daily_close(spark: SparkSession, sf_dir: str, watermark: str = "1 hour") -> DataFrame:
    """The events table as a file stream → daily close per event type."""
    glob = f"{sf_dir.rstrip('/')}/event[s].parquet"
    ev = file_stream(spark, glob, EVENT_SCHEMA)
    prices = ev.select(F.col("event_type").alias("asset_name"), F.col("ts").cast(T.TimestampType()).alias("ts"),
                       F.col("event_id").alias("tie"), F.col("value").alias("price"))
    return run_updates(spark, daily_close(prices, watermark=watermark), "daily-close", ["asset_name", "day"])
