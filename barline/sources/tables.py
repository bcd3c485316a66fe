"""Readers for the driver's Parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; selecting ``columns`` here lets the scan prune the rest."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Floating NaN → SQL NULL (NaN means "missing" in the source pipeline;
    Spark would otherwise order NaN above every number)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (columns is None or f.name in columns)]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floats})
