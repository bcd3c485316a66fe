"""Periodic runs of words by online dyadic square catching (operator 12).

A run of period q is a stretch of words of one document in which words q apart
are equal, with smallest period q, at least ``min_length`` words and ``exponent``
periods long, that no neighbouring word extends.

1. Catchers.  For level k, every completed block of 2^(k-1) words (1 for k = 0)
   sets up a catcher that lives until the word 2^(k+1) - 1 after it.  The left
   root of a square with root length in [2^k, 2^(k+1)) holds such a block, so
   its catcher sees the block again one root length later.
2. Appended words.  Each appended word ends one suffix of block length; its
   rolling hash, advanced from the level below, is compared with the blocks of
   the live catchers.  Both sides are arrays over the words of a batch, so a
   level is one comparison of two views: 2 per word, whatever the texts.
3. Squares into runs.  Catches of one root length by neighbouring blocks belong
   to one stretch; only stretches with as many neighbouring catches as a run of
   that period must have go on.  Each is extended word by word codes (no hash)
   to both sides, at doubling steps, to the longest stretch with that distance.
4. Merging.  A stretch with several distances (the multiples of its period) is
   one run with the smallest; catches inside a known run at a multiple of its
   period are passed over before extension.

Blocks may straddle documents: word codes differ between documents, so such
blocks catch nothing.  Working memory is a constant times the words of a slice
of a batch (``limit`` bytes of text, or one longer text), with no cap on runs or
periods.  Documents are independent, so a task needs no shuffle.

Null and empty texts have no words and no runs.  Repeated rows get equal
results; the id is passed through as it is.  Empty tables give no rows; columns
other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.text import MIX1, MULT, NOT_WORD, Words, mix, pieces, prepare, split_words

MIN_LENGTH = 24
EXPONENT = 3
PIECE = 4 << 20


def catches(blocks: np.ndarray, block: int, roots: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, root length - roots) of every series of at least ``need`` neighbouring blocks caught at one distance.

    ``blocks`` has the hash of the ``block`` words from every word on, and
    ``roots`` is the smallest root length of the level, which has as many.
    """
    n = -((roots - len(blocks)) // block)  # blocks with at least one word in their catcher's life
    if n < need:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a catcher may outlive the text: the places after the last word hold 0
    ahead = np.concatenate([blocks[roots:], np.zeros(roots + block, np.uint64)])
    step = ahead.strides[0]
    seen = as_strided(ahead, (n, roots), (step * block, step))  # one row per catcher, one column per appended word
    series, have = seen == blocks[:n * block:block, None], 1
    while have < need:  # AND of `have` neighbouring blocks
        more = min(have, need - have)
        series = series[:-more] & series[more:]
        have += more
    first = series.copy()
    first[1:] &= ~series[:-1]
    return np.nonzero(first)


def reach(codes: np.ndarray, at: int, distance: int, limit: int) -> int:
    """Number of words from ``at`` on, at most ``limit``, that equal the word ``distance`` later."""
    done, step = 0, 64
    while done < limit:
        step = min(step, limit - done)
        differs = codes[at + done:at + done + step] != codes[at + done + distance:at + done + distance + step]
        k = int(differs.argmax())
        if differs[k]:
            return done + k
        done, step = done + step, step * 2
    return done


def stretch(codes: np.ndarray, at: int, root: int) -> tuple[int, int]:
    """[start, end) of the longest stretch around ``at`` whose words ``root`` apart are equal."""
    right = reach(codes, at, root, len(codes) - root - at)
    flipped = codes[:at + root][::-1]
    left = reach(flipped, 0, root, at)
    return at - left, at + root + right


def catches_of_a_run(roots: int, block: int, min_length: int, exponent: int) -> int:
    """Fewest neighbouring blocks that a run with a period in [roots, 2 * roots) has its catches in."""
    turn = min_length // exponent  # least between the turning points of max(min_length, exponent * q) - q
    equal = min(max(min_length, exponent * q) - q for q in np.clip([roots, turn, turn + 1, 2 * roots - 1], roots, 2 * roots - 1).tolist())
    return (equal - block + 1) // block


def find_runs(codes: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of documents laid end to end, by start; ``codes`` differ between documents."""
    found: dict[tuple[int, int], int] = {}
    inside = np.full(len(codes), -1, np.int64)  # the last run found over each word
    periods: list[int] = []
    longest = int(sizes.max()) if len(sizes) else 0
    place = np.arange(len(codes))
    owner_size = np.repeat(sizes, sizes)
    with np.errstate(over="ignore"):
        hashes = mix((codes.astype(np.uint64) + np.uint64(1)) * MULT)  # one block of one word per word
    level = 0
    while exponent << level <= longest:
        roots, block = 1 << level, max(1, 1 << level >> 1)
        if level > 1:  # suffixes of the doubled length
            half = block >> 1
            with np.errstate(over="ignore"):
                hashes = mix(hashes[:-half] * MIX1 + hashes[half:] + np.uint64(level)) if len(hashes) > half else hashes[:0]
            place, owner_size = place[:len(hashes)], owner_size[:len(hashes)]
        # documents too short for this level's roots leave
        fits = owner_size >= max(min_length, exponent * roots)
        if not fits.all():
            hashes, place, owner_size = hashes[fits], place[fits], owner_size[fits]
        need = catches_of_a_run(roots, block, min_length, exponent)
        first, more = catches(hashes, block, roots, need)
        at, root = place[first * block], roots + more
        if len(at):
            run = inside[at]
            known = (run >= 0) & (run == inside[np.minimum(at + root + block - 1, len(codes) - 1)])
            known &= root % np.array(periods + [1])[run] == 0
            known |= at + root >= len(codes)  # only where two hashes were equal by chance
            for i, q in zip(at[~known].tolist(), root[~known].tolist()):
                start, end = stretch(codes, i, q)
                if end - start < max(min_length, exponent * q) or found.get((start, end), q + 1) <= q:
                    continue
                found[start, end] = q
                inside[start:end] = len(periods)
                periods.append(q)
        level += 1
    return sorted((s, e, q) for (s, e), q in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those in no run after its first period."""
    gone = np.zeros(n + 1, np.int64)
    for s, e, q in runs:
        gone[s + q] += 1
        gone[e] -= 1
    return np.cumsum(gone[:-1]) == 0


def batch_runs(words: Words, min_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """Runs of the documents of a batch, as (start, end, period) in its words."""
    codes = words.owners * max(1, len(words.uniques)) + words.codes
    return find_runs(codes, words.counts, min_length, exponent)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  exponent: int = EXPONENT) -> DataFrame:
    """Per document: its id, n_words, runs (start, length, period; by start, then period) and collapsed,
    the text with every run cut to its first period, words joined by one space."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                words = split_words(part.column("text"))
                found = batch_runs(words, min_length, exponent)
                keep = kept_words(len(words.codes), found)
                s, e, q = (np.array([f[k] for f in found], np.int64) for k in range(3))
                owner = np.searchsorted(words.starts, s, side="right") - 1
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1), side="left").astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                    [pa.array(s - words.starts[owner]), pa.array(e - s), pa.array(q)], names=["start", "length", "period"]))
                left = np.concatenate([[0], np.cumsum(keep)])[words.starts].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(left), words.uniques.take(pa.array(words.codes[keep])).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.counts.astype(np.int64)), runs, pc.binary_join(lists, " ")],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    found = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {found}")


def strongest(runs: str) -> Column:
    """The run with the greatest exact length / period; of equals the first. Null if there is none."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts whose id has a crc32 divisible by 10 continue, from a word that the id picks, as repeats of a few words.

    With n words, h the crc32 and g = h div 10: every word i >= a = g mod n becomes word
    a + (i - a) mod p, with p = 1 + (n - a) div (3 + g mod 8).  Other texts, and those without words, stay.
    """
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"),
                       F.filter(F.split("text", NOT_WORD), lambda w: w != "").alias("w"))
    rows = rows.withColumn("n", F.size("w").cast("long")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.col("g") % F.greatest("n", F.lit(1)))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    told = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", place(i).cast("int")))
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), F.array_join(told, " ")).otherwise(F.col("text")).alias("text"))


