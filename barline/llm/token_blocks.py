"""Token-id files in patched frame-of-reference blocks (operator 8).

``write_tokens`` encodes whole texts, appends an end id to each document and
writes the ids in ascending ``doc_id`` order as a table of chunks; a chunk row
holds whole documents and one binary payload.  ``read_tokens`` decodes the
payloads and returns one row per document with its global start.

Payload (little endian): ``n_ids, n_blocks`` (uint32), then per block of 256 ids
the minimum (uint32), the bit width (uint8), the number of exceptions (uint16)
and the block's start in 64-bit words of the packed area (uint32), then the
exception positions (uint8) and values (uint32), then the packed area.  The
width of a block is the bit length of the 90th percentile of ``id - minimum``;
larger values are exceptions.

Chunks of one partition carry the number of ids before them in it, so only a
sum per partition has to be scanned for global starts.  Rows are range-sorted
by (doc_id, text), so repeated rows stay separate and reruns agree.  Null texts
count as empty (the end id alone); a null doc_id sorts first; an empty table
gives no rows.  Other columns of the input are not read.

Control strings inside texts (``<|endoftext|>`` and the like) get the ids the
tokenizers library gives them: their control ids, or with ``control_ids=False``
those of ordinary text.
"""

from __future__ import annotations

import itertools
import json
import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.text import Words, byte_view, hash_strings, pieces, prepare, ragged, split_words

BLOCK = 256
PERCENTILE = 90
CHUNK_IDS = 1 << 20
END_ID = 2
CACHE_PIECES = 500_000  # known at a time to a worker, if one batch does not bring more
PIECE = 1 << 20  # bytes of text encoded at a time

# texts cut by byte classes: ASCII without the apostrophe and Latin-1 letters, which are in NFC
SIMPLE = r"^[\x00-\x1B !-&(-\x7FÀ-ÖØ-öø-ÿ]*$"
SPACE, LETTER, DIGIT, SIGN = range(4)
CLASS = np.full(256, SIGN, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
CLASS[48:58] = DIGIT

# fixed values: the steps before the merge model for which cutting at white space and by byte classes is right
CUT_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CUT_SPLIT = {"type": "Split", "pattern": {"Regex": CUT_PATTERN}, "behavior": "Removed", "invert": True}
CUT_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


# ---------------------------------------------------------------- blocks

def _pack(v: np.ndarray, width: int) -> np.ndarray:
    """Pack (n, 256) values below 2**width into (n, 4 * width) 64-bit words: 4 lanes of 64 values each."""
    n = len(v)
    lanes = v.reshape(n, 64, 4)
    out = np.zeros((n, width, 4), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return out.reshape(n, 4 * width)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words)
    src, out = words.reshape(n, width, 4), np.empty((n, 64, 4), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        x = src[:, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (src[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = x & mask
    return out.reshape(n, BLOCK)


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """Ids (below 2**32) as patched frame-of-reference blocks."""
    n = len(ids)
    nb = -(-n // BLOCK)
    full = np.full(nb * BLOCK, ids[-1] if n else 0, np.uint32)
    full[:n] = ids
    full = full.reshape(nb, BLOCK)
    low = full.min(axis=1) if nb else np.zeros(0, np.uint32)
    diff = full - low[:, None]
    at = max(0, -(-BLOCK * percentile // 100) - 1)
    width = _bit_length(np.sort(diff, axis=1)[:, at]) if nb else np.zeros(0, np.int64)
    limit = (np.left_shift(np.uint64(1), width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    where, pos = np.nonzero(diff > limit[:, None])
    values = diff[where, pos]
    diff[where, pos] = 0
    starts = np.concatenate([[0], np.cumsum(4 * width)])
    packed = np.zeros(int(starts[-1]), np.uint64)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            packed[starts[own][:, None] + np.arange(4 * w)] = _pack(diff[own].astype(np.uint64), int(w))
    return b"".join([
        np.array([n, nb], "<u4").tobytes(), low.astype("<u4").tobytes(), width.astype("u1").tobytes(),
        np.bincount(where, minlength=nb).astype("<u2").tobytes(), starts[:-1].astype("<u4").tobytes(),
        pos.astype("u1").tobytes(), values.astype("<u4").tobytes(), packed.astype("<u8").tobytes()])


def decode_blocks(data: bytes) -> np.ndarray:
    """The ids of a payload, as little-endian unsigned 32-bit integers."""
    at = 0

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(data, dtype, count, at)
        at += x.nbytes
        return x

    n, nb = (int(x) for x in take("<u4", 2))
    low, width = take("<u4", nb).astype(np.uint64), take("u1", nb).astype(np.int64)
    n_over, starts = take("<u2", nb).astype(np.int64), take("<u4", nb).astype(np.int64)
    total = int(n_over.sum())
    pos, values = take("u1", total), take("<u4", total)
    packed = np.frombuffer(data, "<u8", offset=at)
    out = np.zeros((nb, BLOCK), np.uint64)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            out[own] = _unpack(packed[starts[own][:, None] + np.arange(4 * w)], int(w))
    out[np.repeat(np.arange(nb), n_over), pos] = values
    return (out + low[:, None]).reshape(-1)[:n].astype("<u4")


# ---------------------------------------------------------------- encoding

class PieceIds:
    """Ids of pieces of one tokenizer, with a bounded table of pieces seen by this worker.

    A piece is what the tokenizer's pre-tokenizer passes to its merge model, so a
    text's ids are its pieces' ids in order.  Simple texts (``SIMPLE``) are
    lower-cased and cut by byte classes here; any other text is cut at white
    space, which always ends a piece, and each distinct word is encoded whole by
    the tokenizer.  Known pieces are kept under two independent 64-bit hashes.  A text
    with a control string is never simple.  A file whose steps before the merge model
    differ from these (``cuts`` is false) has its texts encoded whole, one at a time.
    """

    def __init__(self, path: str, control_ids: bool = True):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec["added_tokens"]
        self.controls = [t["content"] for t in added]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and len(t["content"].split()) == 1
                    for t in added)
        self.cuts = plain and spec["normalizer"] == {"type": "Sequence", "normalizers": CUT_NORMALIZERS} and (
            spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [CUT_SPLIT, CUT_BYTES]})
        self.whole, self.piece = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.piece.normalizer = normalizers.Sequence([])
        self.piece.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.whole.encode_special_tokens = not control_ids
        self.piece.encode_special_tokens = True  # no piece holds a whole control string
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def lookup(self, words: pa.Array, tokenizer, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct strings: the flat id table, and each string's start and size in it."""
        key, check = hash_strings(words, seed), hash_strings(words, seed + 1)
        if len(self.keys) + len(key) > CACHE_PIECES:
            self.clear()
        at = np.searchsorted(self.keys, key)
        known = np.zeros(len(key), bool)
        inside = at < len(self.keys)
        known[inside] = (self.keys[at[inside]] == key[inside]) & (self.checks[at[inside]] == check[inside])
        missing = np.flatnonzero(~known)
        if len(missing):
            found = tokenizer.encode_batch_fast(words.take(pa.array(missing)).to_pylist(), add_special_tokens=False)
            got = [e.ids for e in found]
            size = np.fromiter(map(len, got), np.int64, len(got))
            starts = len(self.flat) + np.cumsum(size) - size
            flat = np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(size.sum()))
            self.flat = np.concatenate([self.flat, flat])
            keys = np.concatenate([self.keys, key[missing]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.checks = np.concatenate([self.checks, check[missing]])[order]
            self.starts = np.concatenate([self.starts, starts])[order]
            self.sizes = np.concatenate([self.sizes, size])[order]
            at = np.searchsorted(self.keys, key)
        return self.flat, self.starts[at], self.sizes[at]


def piece_ids(path: str, control_ids: bool = True) -> PieceIds:
    """This worker's encoder for a tokenizer file (kept between tasks)."""
    held = sys.modules.setdefault("_barline_piece_ids", types.ModuleType("_barline_piece_ids"))
    name = f"{path} {control_ids}"
    if name not in vars(held):
        setattr(held, name, PieceIds(path, control_ids))
    return getattr(held, name)


def cut_simple(text: pa.Array) -> Words:
    """Pieces of simple texts: runs of letters or signs, and single digits, of the lower-cased text."""
    raw, off = byte_view(pc.utf8_lower(text))
    kind = CLASS[raw]
    first = np.ones(len(raw), bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    edges = off[:-1][np.diff(off) > 0]
    first[edges] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(raw))
    filled = kind[starts] != SPACE
    starts, ends = starts[filled], ends[filled]
    cuts = np.empty(2 * len(starts) + 1, np.int64)  # piece, gap, piece, gap, ...
    cuts[0:-1:2], cuts[1::2], cuts[-1] = starts, ends, len(raw)
    every = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw)))
    coded = every.take(pa.array(np.arange(len(starts)) * 2)).dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, off))


def _encode(words: Words, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, starts, sizes = table
    per_word = sizes[words.codes]
    counts = np.diff(np.concatenate([[0], np.cumsum(per_word)])[words.starts])
    return flat[ragged(starts[words.codes], per_word)], counts


def encode_texts(text: pa.Array, coder: PieceIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, each followed by ``end_id``, and the ids per text."""
    text = pc.fill_null(text, "")
    if not coder.cuts:
        own = [np.array([*coder.whole.encode(t.as_py(), add_special_tokens=False).ids, end_id], np.uint32) for t in text]
        return np.concatenate([*own, np.zeros(0, np.uint32)]), np.fromiter(map(len, own), np.int64, len(own))
    simple = pc.match_substring_regex(text, SIMPLE)
    for control in coder.controls:
        simple = pc.and_not(simple, pc.match_substring(text, control))
    simple = simple.to_numpy(zero_copy_only=False)
    counts, groups = np.zeros(len(text), np.int64), []
    for own, cut, tokenizer, seed in ((np.flatnonzero(simple), cut_simple, coder.piece, 0),
                                      (np.flatnonzero(~simple), split_words, coder.whole, 2)):
        if len(own):
            words = cut(text.take(pa.array(own)))
            ids, counts[own] = _encode(words, coder.lookup(words.uniques, tokenizer, seed))
            groups.append((own, ids))
    counts += 1
    ends = np.cumsum(counts)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
    for own, ids in groups:
        out[ragged(ends[own] - counts[own], counts[own] - 1)] = ids
    return out, counts


CHUNKS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
    T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())),
    T.StructField("blocks", T.BinaryType())])


def token_chunks(batches: Iterator[pa.RecordBatch], coder: PieceIds, part: int, end_id: int = END_ID) -> Iterator[pa.RecordBatch]:
    """One row a chunk of the ordered documents of a partition, ``PIECE`` bytes of text at a time."""
    seq, before = 0, 0
    for batch in batches:
        for piece in pieces(batch, "text", PIECE):
            ids, counts = encode_texts(piece.column("text"), coder, end_id)
            ends = np.cumsum(counts)
            at = 0
            while at < len(counts):  # whole documents up to CHUNK_IDS ids, one document at least
                base = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, base + CHUNK_IDS, side="right")))
                own = ids[base:ends[to - 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                    pa.array([len(own)], pa.int64()),
                    pa.array([piece.column("doc_id").slice(at, to - at).to_pylist()], pa.list_(pa.int64())),
                    pa.array([counts[at:to]], pa.list_(pa.int64())),
                    pa.array([encode_blocks(own)], pa.binary())], names=CHUNKS.names)
                seq, before, at = seq + 1, before + len(own), to


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, control_ids: bool = True) -> None:
    """Encode all documents and write their chunks to ``path`` in ascending ``doc_id`` order."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = src.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return token_chunks(batches, piece_ids(tokenizer, control_ids), TaskContext.get().partitionId(), end_id)

    ordered.mapInArrow(run, CHUNKS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens, ids_crc32 and part of every document."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    schema = "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in CHUNKS.names}
                ids, sizes = decode_blocks(row["blocks"].as_py()), row["sizes"].values.to_numpy()
                ends = np.cumsum(sizes)
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * int(e - s):4 * int(e)]) for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays([
                    row["doc_ids"].values, pa.array([row["part"].as_py()] * len(sizes), pa.int32()),
                    pa.array(row["before"].as_py() + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])

    rows = chunks.mapInArrow(run, schema)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written partition
    offsets = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return rows.join(offsets, "part").select(
        "doc_id", (F.col("_offset") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")
