"""Shared helpers: words of Arrow text batches, row keys, session settings.

A word is a run of characters other than space and U+0009..U+000D; null texts
have no words.  All helpers work on whole texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.session import configure, ensure_checkpoint_dir, scratch_path

def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name


WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: library defaults and small Arrow batches.

    Texts may be long, so a batch holds few rows; the byte bound applies where
    the Spark version knows it.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ensure_checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete the files of ``written`` tables that no later step reads, neither itself nor to recompute a lost part."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give memory that this process has freed back to the system.

    A driver that has trained goes on for long; the C library and Arrow would keep the training's memory for it.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def n_words(text: str = "text") -> Column:
    """Number of words of a text column (long); null texts count 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


@dataclass
class Words:
    """Words of a batch of texts: ``codes`` index ``uniques``; text i owns codes[starts[i]:starts[i+1]]."""

    uniques: pa.Array
    codes: np.ndarray
    starts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)


def split_words(text: pa.Array) -> Words:
    """Split whole texts at ASCII white space and number their distinct words."""
    if not len(text):
        return Words(pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(1, np.int64))
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets -= offsets[0]
    codes, uniques = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = np.flatnonzero(pc.equal(uniques, "").to_numpy(zero_copy_only=False))
    if len(empty):
        keep = codes != empty[0]
        codes = codes[keep]
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return Words(uniques, codes, offsets)


def byte_view(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings in one array, and the offset of each string."""
    arr = words.cast(pa.large_binary())
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + size)."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


MIX1, MIX2, MULT = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection on 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


BYTE_TERMS = mix(np.arange(1, 257, dtype=np.uint64) * MULT)


def place_terms(n: int, seed: int = 0) -> np.ndarray:
    """Odd 64-bit multipliers of the byte positions 0..n-1."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)) * MIX1) | np.uint64(1)


PLACES = place_terms(64, seed=1)


def hash_strings(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit multilinear hash of each string's bytes, mixed with its length."""
    raw, off = byte_view(words)
    size = np.diff(off)
    if not len(size):
        return np.zeros(0, np.uint64)
    pos = np.arange(len(raw), dtype=np.int64) - np.repeat(off[:-1], size)
    with np.errstate(over="ignore"):
        terms = BYTE_TERMS[raw] * place_terms(int(size.max()) if len(size) else 0, seed)[pos]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(terms, out=total[1:])
        return mix(total[off[1:]] - total[off[:-1]] + size.astype(np.uint64) * MULT)


def rolling(x: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive 64-bit values (length ``len(x) - k + 1``), by doubling."""
    n = len(x)
    if n < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        part, have, out, at = x, 1, None, 0
        while True:
            if k & have:
                seg = part[at:at + n - k + 1]
                out = mix(seg + MULT) if out is None else mix(out * MULT + seg)
                at += have
            if have * 2 > k:
                return out
            part = mix(part[:-have] * MIX1 + part[have:] + np.uint64(have))
            have *= 2


def subword_ids(words: pa.Array, sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of ``<word>``: (index of the word, bucket) for every n-gram of the given sizes."""
    marked = pc.binary_join_element_wise(*[x.cast(pa.large_string()) for x in (pa.scalar("<"), words, pa.scalar(">"), pa.scalar(""))])
    raw, off = byte_view(marked)
    size = np.diff(off)
    owner = np.repeat(np.arange(len(size)), size)
    at, ids = [], []
    x = raw.astype(np.uint64)
    for k in sizes:
        if len(x) < k:
            continue
        code = np.zeros(len(x) - k + 1, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                code = code * np.uint64(257) + x[j:len(x) - k + 1 + j] + np.uint64(1)
        inside = owner[:len(code)] == owner[k - 1:k - 1 + len(code)]
        at.append(owner[:len(code)][inside])
        ids.append((mix(code[inside] ^ PLACES[k]) % np.uint64(buckets)).astype(np.int64))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(at), np.concatenate(ids)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = 8 << 20):
    """Slices of a batch whose texts hold about ``limit`` bytes (at least one row each): bounds the working memory."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, at = np.cumsum(size), 0
    while at < len(size):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(at, end - at)
        at = end
