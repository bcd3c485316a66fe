"""Mixing sources to target weights by a distributed prefix-sum cut (operator 5).

1. Sizes: words per document, kept in a narrow table without texts.
2. Targets: sources in code point order (null last) weigh 3, 1, 2, repeating,
   and share ``SHARE`` of all words.  A target stops at ``MAX_EPOCHS`` times its
   source; the excess goes to the others by weight.  Closed form: with caps
   sorted by cap / weight, a source is capped if its ratio is at most the level
   that the remaining words and weights give at its place.
3. Order: a hash of the id and the text is each document's random key, so rows
   that share an id are spread too.  Rows alike in id, source and text are one
   counted row until the end.  Equal key ranges of every source (``RANGES``, the key's leading hex digits) are sorted apart, and
   a prefix sum over the small table of (source, range) totals gives the words
   before each range, so a source holding a third of all rows is spread evenly.
4. Cut: a target of t words over a source of s words takes every document
   ``floor(t / s)`` times and, of the rest, the documents in key order up to the
   exact number of words; the last one is taken in part.

Null texts have 0 words.  Null sources are one source.  Rows of equal key are
ordered by id, size and text hash, so reruns agree; repeated rows that are alike
are taken one after another.  An empty table gives no rows.  Only the id, source
and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.text import fresh, n_words, prepare, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
RANGES = 3  # hex digits: 4096 key ranges a source


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target): the words each source gives, one row per source.

    The windows run over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    per = per.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    per = per.withColumn("level", F.try_divide(left, F.sum("weight").over(after)))
    # the first uncapped source in this order sets the level of all after it (of equal ratios, the highest level)
    per = per.withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    level = -F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), (-F.col("level")).alias("down")))).over(everything)["down"]
    per = per.withColumn("final", level)
    target = F.when(F.col("open"), F.least(F.col("cap"), F.col("final") * F.col("weight"))).otherwise(F.col("cap"))
    return per.select("source", "source_size", target.alias("target"))


def sized(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Id, source, words, random key and text hash of every document, written without the texts."""
    prepare(docs.sparkSession)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    key = F.md5(F.concat(blank(F.col("doc_id").cast("string")), F.lit("-"), F.md5(blank(F.col("text")))))
    return written(src.select("doc_id", "source", n_words().alias("size"), key.alias("key"),
                              F.xxhash64("text").alias("tie")), "mixing_sizes")


def cut(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Add source_size, target, taken (words) and copies (whole documents; the last one by its larger part)."""
    block = F.substring("key", 1, RANGES)
    rows = sizes.groupBy("doc_id", "source", "size", "key", "tie").agg(F.count(F.lit(1)).alias("_rows")).withColumn("block", block)
    totals = sizes.withColumn("block", block).groupBy("source", "block").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("_s"), F.col("block").alias("_b"),
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    goals = goals.withColumnRenamed("source", "_g")
    offsets = offsets.join(goals, F.col("_s").eqNullSafe(F.col("_g"))).drop("_g")
    inside = Window.partitionBy("source", "block").orderBy("key", "doc_id", "size", "tie").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum(F.col("size") * F.col("_rows")).over(inside), F.lit(0)))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    rows = rows.withColumn("_row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)))
    rows = rows.withColumn("_in", F.col("_in") + F.col("_row") * F.col("size"))
    goal = F.round("target").cast("long")
    epochs = F.coalesce(F.floor(F.try_divide(goal, F.col("source_size"))), F.lit(0))
    rest = goal - epochs * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("_offset") - F.col("_in"), F.lit(0)), F.col("size"))
    whole = (2 * part >= F.col("size")) & (rest > F.col("_offset") + F.col("_in"))
    return rows.select(
        "doc_id", "source", "tie", "size", "source_size", "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
        (epochs + whole.cast("long")).cast("long").alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """Size, target and words taken of every document."""
    sizes = sized(docs)
    return cut(sizes, targets(sizes))


def repeat(count: Column) -> Column:
    """An array with one element per copy, to explode."""
    return F.when(count > 0, F.sequence(F.lit(1).cast("long"), count))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns.

    A reader that packs tokens can cut a document at the budget; here documents
    stay whole, and the last one of a source is taken if at least half of it is.
    Rows join by source, id and text hash; repeated rows alike each get the
    rounded mean of their copies.
    """
    each, tie, copy, columns = fresh(docs, "_each"), fresh(docs, "_tie"), fresh(docs, "_copy"), docs.columns
    chosen = mix(docs).groupBy("doc_id", "tie", "source").agg(F.round(F.sum("copies") / F.count(F.lit(1))).cast("long").alias(each))
    chosen = chosen.select(F.col("doc_id").alias("_i"), F.col("tie").alias("_t"), F.col("source").alias("_s"), each)
    rows = docs.withColumn(tie, F.xxhash64("text"))
    joined = rows.join(chosen, rows["doc_id"].eqNullSafe(chosen["_i"]) & (rows[tie] == chosen["_t"])
                       & rows["source"].eqNullSafe(chosen["_s"]))
    return joined.withColumn(copy, F.explode(repeat(F.col(each)))).select(*[rows[c] for c in columns])
