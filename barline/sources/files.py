"""File sources and sinks: CSV import/export with explicit schemas, Parquet by default.

A missing input path is skipped with a warning (empty frame of the schema),
as the batch stages of the source pipeline do.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.session import materialize

log = logging.getLogger(__name__)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, timestamp_format: str | None = None,
             base_path: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data)."""
    if not _exists(spark, path):
        log.warning("file not found, skipping: %s", path)
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.csv(path)


def read_csv_lenient(spark: SparkSession, path: str, schema: T.StructType, timestamp_format: str | None = None,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1/S2 for files with bad lines: (rows, rejected).

    ``rows`` are the lines that parse to ``schema`` as a whole; ``rejected``
    (``line``, ``file``) holds every other line as it stands: a value that does
    not parse, too few or too many fields.  Empty fields are nulls, blank lines
    are no lines.  The files are parsed once, into the checkpoint folder, from
    which both results are read; a rejected line never ends the job.  The names
    of the two extra columns evade those of the schema.  A missing path gives two
    empty frames.
    """
    names = {f.name.lower() for f in schema.fields}
    bad, source = (next(c for c in (n + "_" * k for k in range(len(names) + 1)) if c not in names) for n in ("_line", "_file"))
    rejected_schema = T.StructType([T.StructField("line", T.StringType()), T.StructField("file", T.StringType())])
    if not _exists(spark, path):
        log.warning("file not found, skipping: %s", path)
        return spark.createDataFrame([], schema), spark.createDataFrame([], rejected_schema)
    # without column pruning a line is judged by all its fields, whatever is selected later
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())])).options(
        header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=bad, columnPruning=False)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    parsed = materialize(reader.csv(path).withColumn(source, F.col("_metadata.file_path")), "csv")
    rows = parsed.where(F.col(bad).isNull()).select(*[F.col(f"`{c}`") for c in schema.names])
    return rows, parsed.where(F.col(bad).isNotNull()).select(F.col(bad).alias("line"), F.col(source).alias("file"))


def write_csv(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("asset_name",)) -> None:
    """S3 export: header CSV, one folder per asset."""
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("asset_name",)) -> None:
    """S3 default sink: Parquet partitioned by asset (later reads prune by asset)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    if not _exists(spark, path):
        log.warning("file not found, skipping: %s", path)
        return spark.createDataFrame([], schema) if schema else spark.createDataFrame([], "x int").limit(0)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def write_json(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """JSON lines sink (e.g. drift reports), optionally one folder per key."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
