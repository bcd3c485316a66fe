"""Removal of repeated passages of ``WINDOW`` words, exact over the whole corpus (operator 9).

A word goes if a window of 50 consecutive words that covers it also starts in a
document with a smaller id; windows are judged on the input.

1. Candidates.  A window's anchor is the least hash of its runs of ``GRAM``
   words.  Equal windows have equal anchors, so a window that occurs in two
   different texts has an anchor found in two texts: grouping the anchors loses
   no repeat, and a document has about one anchor in twenty words.
2. Index.  Every distinct window of a document whose anchor is shared is hashed
   (96 bits) and grouped to the smallest document that has it.  A window
   repeated in thousands of documents is one pre-aggregated row, and no pairs of
   documents are made.
3. Probe.  Windows of documents other than the first holder of their anchor look
   up that smallest document; those with a smaller one are hits.
4. Extension.  The words of a document covered by hits, that is its maximal
   exact repeats, are removed.

Exact copies: a text whose smallest document is another one loses all its words
if it has a window, and takes no part in steps 2 and 3.

The method asked for, an index of non-overlapping reference blocks probed by
every rolling window, would shuffle one row per corpus word; the README gives
the figures and the reason for anchors chosen by content instead.

Null texts have no words.  A null id counts as larger than any other and as one
document.  Repeated rows (same id and text) get equal results.  Empty tables
give no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.text import MULT, Words, hash_strings, mix, pieces, prepare, rolling, split_words, written

WINDOW = 50
GRAM = 10
LAST = (1 << 63) - 1


def window_anchors(words: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window of a batch, and the window's anchor."""
    owner = words.owners
    if len(ids) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = rolling(ids, GRAM)
    have, need = 1, WINDOW - GRAM + 1
    while have < need:  # least of `have` consecutive run hashes
        step = min(have, need - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    at = np.flatnonzero(owner[:len(ids) - WINDOW + 1] == owner[WINDOW - 1:])
    return at, low[at]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def distinct(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Indices of the first of each (owner, value)."""
    with np.errstate(over="ignore"):
        return np.sort(np.unique(mix(value ^ mix(owner.astype(np.uint64) * MULT + MULT)), return_index=True)[1])


def tagged(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(value ^ mix(owner.astype(np.uint64) * MULT + MULT))


def list_pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a column of lists of longs; null lists have no values."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), size), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def anchors(docs: DataFrame) -> DataFrame:
    """(anchor, doc_id, tie): the distinct anchors of every row of (doc_id, tie, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = split_words(part.column("text"))
                at, anchor = window_anchors(words, hash_strings(words.uniques)[words.codes])
                owner = words.owners[at]
                own = distinct(owner, anchor)
                yield pa.RecordBatch.from_arrays(
                    [signed(anchor[own]), *[part.column(c).take(pa.array(owner[own])) for c in ("doc_id", "tie")]],
                    names=["anchor", "doc_id", "tie"])

    return docs.mapInArrow(run, "anchor long, doc_id long, tie long")


def candidate_windows(docs: DataFrame) -> DataFrame:
    """(w, v, doc_id, tie, probe): distinct windows whose anchor is in ``held`` or ``sought`` of (doc_id, tie, text, held, sought)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = split_words(part.column("text"))
                ids = hash_strings(words.uniques)[words.codes]
                at, anchor = window_anchors(words, ids)
                owner = words.owners[at]
                tag = tagged(owner, anchor)
                probe = np.isin(tag, tagged(*list_pairs(part.column("sought"))))
                keep = probe | np.isin(tag, tagged(*list_pairs(part.column("held"))))
                at, owner, probe = at[keep], owner[keep], probe[keep]
                w, v = (rolling(x, WINDOW)[at] if len(at) else np.zeros(0, np.uint64)
                        for x in (ids, hash_strings(words.uniques, seed=3)[words.codes]))
                own = distinct(owner, w)
                yield pa.RecordBatch.from_arrays(
                    [signed(w[own]), pa.array((v[own] >> np.uint64(33)).astype(np.int32)),
                     *[part.column(c).take(pa.array(owner[own])) for c in ("doc_id", "tie")], pa.array(probe[own])],
                    names=["w", "v", "doc_id", "tie", "probe"])

    return docs.mapInArrow(run, "w long, v int, doc_id long, tie long, probe boolean")


def cleaned(docs: DataFrame) -> DataFrame:
    """Result rows of (out_id, text, copy, hits): words covered by a window in ``hits`` go, or all of a copy that has a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = split_words(part.column("text"))
                n = words.counts
                ids = hash_strings(words.uniques)[words.codes]
                gone = np.zeros(len(ids) + 1, np.int64)
                row, hit = list_pairs(part.column("hits"))
                if len(hit):
                    owner = words.owners
                    at = np.flatnonzero(owner[:len(ids) - WINDOW + 1] == owner[WINDOW - 1:])
                    at = at[np.isin(tagged(owner[at], rolling(ids, WINDOW)[at]), tagged(row, hit))]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + WINDOW, -1)
                copy = pc.fill_null(part.column("copy"), False).to_numpy(zero_copy_only=False) & (n >= WINDOW)
                keep = (np.cumsum(gone[:-1]) == 0) & ~np.repeat(copy, n)
                ends = np.concatenate([[0], np.cumsum(keep)])[words.starts]
                lists = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), words.uniques.take(pa.array(words.codes[keep])).cast(pa.string()))
                text = pc.binary_join(lists, " ")
                sha = [hashlib.sha256(t.as_buffer()).hexdigest() for t in text.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("out_id"), pa.array(n.astype(np.int64)), pa.array((n - np.diff(ends)).astype(np.int64)),
                     pa.array(sha, pa.string()), text], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def window_hits(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, hits): the hashes of a document's windows that a smaller document has, for (doc_id, tie, text)."""
    spots = anchors(docs)
    shared = spots.groupBy("anchor").agg(F.min("tie").alias("a"), F.max("tie").alias("b"), F.min("doc_id").alias("first"))
    shared = shared.where(F.col("a") != F.col("b")).select("anchor", "first")
    mine = spots.join(shared, "anchor")
    # in the first holder of an anchor its windows only serve as references
    per_doc = mine.groupBy("doc_id", "tie").agg(
        F.collect_set(F.when(F.col("doc_id") == F.col("first"), F.col("anchor"))).alias("held"),
        F.collect_set(F.when(F.col("doc_id") != F.col("first"), F.col("anchor"))).alias("sought"))
    windows = written(candidate_windows(docs.join(per_doc, ["doc_id", "tie"]).select("doc_id", "tie", "text", "held", "sought")), "windows")
    first = windows.groupBy("w", "v").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = first.where(F.col("first") != F.col("last")).drop("last")
    hits = windows.where("probe").join(first, ["w", "v"]).where(F.col("first") < F.col("doc_id"))
    return hits.groupBy("doc_id", "tie").agg(F.collect_set("w").alias("hits"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """n_words, n_removed, kept_sha256 and the kept text of every document."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(doc_id).cast("long").alias("out_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc_id"),
                      F.xxhash64(F.col(text)).alias("tie"), F.col(text).alias("text"))
    hits = written(window_hits(src.select("doc_id", "tie", "text")), "window_hits")
    keys = src.select("doc_id", "tie").distinct()
    smallest = keys.groupBy("tie").agg(F.min("doc_id").alias("least"))
    marks = keys.join(smallest, "tie").select("doc_id", "tie", (F.col("least") < F.col("doc_id")).alias("copy"))
    marks = marks.join(hits, ["doc_id", "tie"], "left").where(F.col("copy") | F.col("hits").isNotNull())
    return cleaned(src.join(marks, ["doc_id", "tie"], "left").select("out_id", "text", "copy", "hits"))
