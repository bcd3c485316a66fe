"""Corpus pipeline: the stages applied to ``documents`` one after another, each written and reread.

Every stage but the last returns rows of its input with the input's own columns;
the last returns what the token files hold per document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import decontaminate, mixing, near_dedup, token_blocks, toxicity
from barline.llm.queries import tokenizer_path
from barline.llm.text import fresh, prepare, scratch_path, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is below the threshold."""
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "_toxicity")
    return toxicity.score(docs, model, out=score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the smallest id."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark passage."""
    prepare(spark)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")).distinct()
    tie, columns = fresh(docs, "_text"), docs.columns
    rows = docs.withColumn(tie, F.xxhash64("text"))
    return rows.join(found, rows["doc_id"].eqNullSafe(found["_id"]) & (rows[tie] == found["_tie"]), "left_anti").select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files of all rows and return what they hold per row."""
    prepare(spark)
    path = scratch_path(spark, "token_blocks")
    token_blocks.write_tokens(docs, path, tokenizer_path())
    return token_blocks.read_tokens(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("token_blocks", write_token_files),
]

# toxicity is a trained network, and near-duplicate classes need a graph closure: not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; each stage's result is written as Parquet and reread."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
