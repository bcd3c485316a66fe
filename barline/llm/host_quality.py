"""Quality rules judged per host with a shrunken failure rate (operator 3).

1. Text statistics and the base rules per document, in Arrow batches.
2. Failures per host: one partial aggregation, so a hot host is cheap.
3. An empirical Beta prior over host failure rates (method of moments); each
   host's rate is its posterior mean ``(failed + a) / (n + a + b)``.
4. A document is kept if it passes the base rules and its host's shrunken rate
   stays below ``max_fail_rate``.

Hosts are compared null-safely (a null host is a host of its own).  Null and
empty texts have no words and fail the word-count rule.  Repeated rows each
get a row; an empty table gives an empty result.  Repeated 8-word windows are
compared by a 64-bit hash within a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.text import MULT, byte_view, hash_strings, mix, pieces, prepare, rolling, split_words, written

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MAX_FAIL_RATE = 0.5
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _duplicate_lines(text: pa.Array) -> np.ndarray:
    lists = pc.split_pattern(pc.fill_null(text.cast(pa.large_string()), ""), "\n")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    lines = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    owner = np.repeat(np.arange(len(text)), np.diff(offsets))
    coded = lines.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(coded.dictionary)), 0).to_numpy(zero_copy_only=False)
    keep = filled[code]
    owner, code = owner[keep], code[keep]
    again = pd.Series(owner * np.int64(len(coded.dictionary) + 1) + code).duplicated().to_numpy()
    return np.bincount(owner[again], minlength=len(text)).astype(np.int64)


def text_stats(text: pa.Array) -> dict[str, np.ndarray]:
    """The five statistics of each whole text."""
    n = len(text)
    words = split_words(text)
    raw, off = byte_view(words.uniques)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    length = chars[off[1:]] - chars[off[:-1]]
    owner = words.owners
    word_chars = np.bincount(owner, weights=length[words.codes], minlength=n).astype(np.int64)
    ids = hash_strings(words.uniques)[words.codes]
    repeated = np.zeros(len(ids), bool)
    if len(ids) >= WINDOW:
        inside = owner[:len(ids) - WINDOW + 1] == owner[WINDOW - 1:]
        start = np.flatnonzero(inside)
        with np.errstate(over="ignore"):
            key = mix(rolling(ids, WINDOW)[start] + owner[start].astype(np.uint64) * MULT)
        hits = start[pd.Series(key).duplicated(keep=False).to_numpy()]
        cover = np.zeros(len(ids) + 1, np.int32)
        np.add.at(cover, hits, 1)
        np.add.at(cover, hits + WINDOW, -1)
        repeated = np.cumsum(cover[:-1]) > 0
    symbols = pc.fill_null(pc.count_substring_regex(text, SYMBOLS), 0).to_numpy(zero_copy_only=False)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": symbols.astype(np.int64),
        "n_dup_lines": _duplicate_lines(text),
        "n_repeat_words": np.bincount(owner[repeated], minlength=n).astype(np.int64),
    }


def document_stats(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns and the statistics of ``text``."""
    src = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    schema = src.drop("_text").schema
    for c in STATS:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text"):
                stats = text_stats(part.column("_text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(stats[c]) for c in STATS], names=[*keep, *STATS])

    return src.mapInArrow(run, schema)


def host_rates(stats: DataFrame, host: str) -> DataFrame:
    """Per host: documents, failures and the failure rate shrunk by an empirical Beta prior.

    With m and v the mean and variance of the raw host rates, the prior's weight
    is ``m (1 - m) / v - 1`` (at least ``MIN_WEIGHT``; with no spread between
    hosts it is ``NO_SPREAD_WEIGHT`` documents).
    """
    hosts = stats.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"),
                                    F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    raw = F.try_divide(F.col("n_failed"), F.col("n_docs"))
    m, v = hosts.agg(F.coalesce(F.avg(raw), F.lit(0.0)), F.coalesce(F.var_pop(raw), F.lit(0.0))).first()
    weight = max(MIN_WEIGHT, m * (1 - m) / v - 1) if v > 0 else NO_SPREAD_WEIGHT
    return hosts.withColumn(
        "fail_rate", (F.col("n_failed") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(float(weight))))


MIN_WEIGHT = 1.0
NO_SPREAD_WEIGHT = 100.0


def host_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                 max_fail_rate: float = MAX_FAIL_RATE) -> DataFrame:
    """Statistics, base verdict, host rate and final verdict of every document."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("host"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    stats = written(document_stats(src, "text", ("doc_id", "host")).withColumn("base_failed", failed), "host_quality")
    hosts = host_rates(stats, "host").withColumnRenamed("host", "_host")
    return (
        stats.join(hosts, stats["host"].eqNullSafe(hosts["_host"]), "left").drop("_host")
        .withColumn("kept", ~F.col("base_failed") & (F.col("fail_rate") < max_fail_rate))
    )
