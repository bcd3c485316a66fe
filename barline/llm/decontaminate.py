"""Benchmark decontamination as a prefix-filtered set join (operator 4), in DataFrame functions only.

An item window is ``WINDOW`` consecutive words of a benchmark item, or the whole
item if it is shorter.  A document is hit where a window's words occur in it.

1. A window is a set of shingles of ``SHINGLE`` words at known offsets (a
   shorter window is one shingle of its own length).  All of them must occur, so
   any one is a necessary prefix; the rarest in the corpus is the cheapest.
2. One pass over the documents keeps the shingles that the benchmark has, with
   the words around each; everything after works on these hits.
3. Each window takes as prefix its shingle with the fewest hits.  Joining
   prefixes to hits gives the position a window would start at; it must lie
   inside the document (positional and length bounds).
4. The words there are compared with the window's words, so the shingle hashes
   decide nothing.

The pass over the corpus looks its shingles up in a broadcast set while the
benchmark has at most ``MAX_BROADCAST`` distinct ones (8 bytes each, counted
first); a larger benchmark is joined by a shuffle of narrow rows, and the words
around a hit are added afterwards.  The results are the same.
Rows are told apart by (doc_id, text hash); repeated rows get equal results.
Null texts have no words and hit nothing; items without words have no window;
null ids compare as equal.  Empty tables give no hits.  Columns other than ids
and texts are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.text import prepare, written

WINDOW = 10
SHINGLE = 5
MAX_BROADCAST = 1_000_000
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str) -> Column:
    """Words of a text: A-Z lower-cased, cut at ASCII characters other than letters and digits."""
    col = F.coalesce(F.col(text), F.lit(""))
    # lower() changes only A-Z in ASCII texts, and is much the faster there
    small = F.when(col.rlike(r"^\p{ASCII}*$"), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))
    return F.array_remove(F.split(small, GAP), "")


def shingle_key(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(F.col(words), at + k) for k in range(size)])


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, words): the windows of every item, repeated ones once per item."""
    cut = items.select(F.col(item_id).alias("item_id"), words_of(text).alias("all")).where(F.size("all") > 0)
    first = F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - WINDOW, F.lit(0))))
    return cut.select("item_id", "all", first.alias("at")).select(
        "item_id", F.slice("all", F.col("at") + 1, F.lit(WINDOW)).alias("words")).distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window, words, offset, key): the shingles of every distinct window text."""
    distinct = windows.select("words").distinct().withColumn("window", F.xxhash64("words"))
    size = F.least(F.size("words"), F.lit(SHINGLE))
    rows = distinct.withColumn("offset", F.explode(F.sequence(F.lit(0), F.size("words") - size)))
    key = F.coalesce(*[F.when(size == k, shingle_key("words", F.col("offset"), k)) for k in range(SHINGLE, 0, -1)])
    return rows.select("window", "words", "offset", key.alias("key"), size.alias("size"))


def corpus_hits(docs: DataFrame, shingles: DataFrame, doc_id: str, text: str, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """A row marked ``first`` for every document, and one per shingle of it that the benchmark has (key not null).

    ``near`` holds the words from ``WINDOW - 1`` before the shingle's start to
    ``WINDOW`` after it, so a window around the shingle is compared without the text.
    """
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("tie"), words_of(text).alias("words"))
    rows = cut.select("*", F.posexplode_outer("words").alias("at", "_word")).drop("_word")
    counted = rows.withColumn("n_words", F.size("words"))
    known = shingles.select("size", "key").distinct()
    few = known.count() <= max_broadcast
    low = F.greatest(F.col("at") - (WINDOW - 1), F.lit(0))
    near = F.when(F.col("found"), F.slice("words", low + 1, F.col("at") - low + WINDOW))
    row = ("doc_id", "tie", "n_words", "key", "at", "found")

    def around(size: int) -> DataFrame:
        keys = known.where(F.col("size") == size).select("key", F.lit(True).alias("found"))
        inside = counted.withColumn("key", F.when(F.col("at") + size <= F.col("n_words"), shingle_key("words", F.col("at"), size)))
        if few:
            inside, keys = inside.select(*row[:-1], "words"), F.broadcast(keys)
        else:
            inside = inside.select(*row[:-1])
        if size < SHINGLE:
            return inside.join(keys, "key").withColumn("first", F.lit(False))
        met = inside.join(keys, "key", "left").withColumn("first", F.coalesce(F.col("at") == 0, F.lit(True)))
        return met.where(F.col("found") | F.col("first")).withColumn("key", F.when(F.col("found"), F.col("key")))

    hits = around(SHINGLE)
    for size in range(1, SHINGLE):  # items shorter than a shingle; these scans end early where there are none
        hits = hits.unionByName(around(size))
    if not few:
        words = cut.select(F.col("doc_id").alias("_d"), F.col("tie").alias("_t"), "words").dropDuplicates(["_d", "_t"])
        hits = hits.join(words, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")))
    return hits.select("doc_id", "tie", "n_words", "key", "at", low.alias("low"), near.alias("near"), "first")


def occurrences(hits: DataFrame, shingles: DataFrame) -> DataFrame:
    """(doc_id, tie, window, start, size): every occurrence of a window, found by its rarest shingle and verified."""
    found = hits.where(F.col("key").isNotNull())
    often = found.groupBy("key").agg(F.count(F.lit(1)).alias("hits"))
    rarest = Window.partitionBy("window", "words").orderBy(F.coalesce("hits", F.lit(0)), "offset")
    prefix = shingles.join(often, "key", "left").withColumn("rank", F.row_number().over(rarest)).where(
        (F.col("rank") == 1) & F.col("hits").isNotNull())  # a shingle without hits rules its window out
    joined = found.join(prefix.select("key", "window", "words", "offset"), "key")
    start, size = F.col("at") - F.col("offset"), F.size("words")
    return joined.where(
        (start >= 0) & (start + size <= F.col("n_words"))
        & (F.slice("near", start - F.col("low") + 1, size) == F.col("words"))
    ).select("doc_id", "tie", "window", "words", start.alias("start"), size.alias("size")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per document: doc_id, tie (its text's hash), n_words, n_hit, items (sorted ids, as strings) and contaminated."""
    prepare(docs.sparkSession)
    windows = written(item_windows(items, item_id), "item_windows")
    shingles = written(window_shingles(windows), "window_shingles")
    hits = written(corpus_hits(docs, shingles, doc_id, text, max_broadcast), "corpus_hits")
    found = written(occurrences(hits, shingles), "window_occurrences")
    row = ("doc_id", "tie")
    covered = found.select(*row, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("at")).distinct()
    n_hit = covered.groupBy(*row).agg(F.count(F.lit(1)).alias("n_hit"))
    named = found.select(*row, "words").distinct().join(windows, "words").select(*row, "item_id").distinct()
    per_item = named.groupBy(*row).agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    marked = n_hit.join(per_item, [n_hit[c].eqNullSafe(per_item[c]) for c in row], "left").select(
        *[n_hit[c].alias("_" + c) for c in row], "n_hit", "items")
    # every row of the documents has one row marked first, besides its hits
    every = hits.where("first").groupBy(*row).agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("_rows"))
    joined = every.join(marked, [every[c].eqNullSafe(F.col("_" + c)) for c in row], "left")
    return joined.select(
        *[every[c] for c in row], F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))).alias("_copy")).drop("_copy")
