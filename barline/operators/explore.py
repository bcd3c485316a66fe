"""Exploration aggregates: counts, null profile, return distribution,
correlation matrix, and per-asset head/tail."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.operators.sequential import top_k_per_group
from barline.session import materialize

QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
SKETCH_ACCURACY = 10_000  # of the edges' sketch; only the evenness of the ranges depends on it


def rows_per_asset(df: DataFrame, key: str = "asset_name") -> DataFrame:
    """Row count per asset (partial + final aggregate)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column and their maximum, one aggregate pass."""
    cols = df.columns
    counts = [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(cols)]
    agg = df.agg(*counts)
    return agg.select(F.greatest(*[F.col(f"nulls_{i}") for i in range(len(cols))]).alias("null_max")) \
        if len(cols) > 1 else agg.select(F.col("nulls_0").alias("null_max"))


def _join_same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``names``, nulls equal as in groupBy; the right side's names go."""
    other = right.withColumnsRenamed({c: f"{c}_right" for c in names})
    on = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{c}_right")) for c in names])
    return left.join(other, on, how).drop(*[f"{c}_right" for c in names])


def _ranks_between(ranks: Column, below: Column, count: Column) -> Column:
    """Of the wanted ranks (from 0), those among the ``count`` values that follow the ``below`` smallest."""
    return F.filter(ranks, lambda r: (r >= below) & (r < below + count))


def distribution(df: DataFrame, x: str, keys: Sequence[str] = ("asset_name",), levels: int = 10) -> DataFrame:
    """Exact quartiles (linear interpolation), mean and sample std per group.

    No group is held or sorted as a whole.  A quantile sketch proposes
    ``2**levels - 1`` edges a group; the values are counted exactly per range
    between edges, the counts' prefix sums tell which ranges hold the wanted
    ranks, and only those ranges (at most two a quartile) are sorted, as
    distinct values with counts.  The sketch decides how even the ranges are,
    not what is returned.  The two columns read and the edges are written once
    to the checkpoint folder, so a lost executor cannot meet other edges.

    Null and NaN values are missing; a group of missing values alone has
    n = 0 and nulls.  Null keys form a group.
    """
    ks = [f"_k{i}" for i in range(len(keys))]
    value = F.nullif(F.col(x).cast("double"), F.lit(float("nan")))
    rows = materialize(df.select(*[F.col(k).alias(a) for k, a in zip(keys, ks)], value.alias("_v")), "values")
    cuts = F.lit([i / 2 ** levels for i in range(1, 2 ** levels)])
    stats = rows.groupBy(*ks).agg(
        F.count("_v").alias("n"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
        F.percentile_approx("_v", cuts, F.lit(SKETCH_ACCURACY)).alias("_edges"))
    place = [F.lit(q) * (F.col("n") - 1) for q in QUANTILES]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in place for f in (F.floor, F.ceil)]))
    stats = materialize(stats.withColumn("_ranks", ranks), "edges")

    # binary search: how many edges are not above the value
    steps = F.lit([2 ** i for i in reversed(range(levels))])
    cell = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.get(F.col("_edges"), at + step - 1) <= F.col("_v"), step).otherwise(0))
    found = rows.where(F.col("_v").isNotNull())
    placed = _join_same(found, stats.select(*ks, "_edges"), ks).select(*ks, "_v", cell.alias("_cell"))
    counts = placed.groupBy(*ks, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*ks).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_below", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    hit = _join_same(counts, stats.select(*ks, "_ranks"), ks).select(
        *ks, "_cell", "_below", _ranks_between(F.col("_ranks"), F.col("_below"), F.col("_n")).alias("_ranks")).where(F.size("_ranks") > 0)

    # the ranges that hold a wanted rank, as distinct values with counts
    inside = _join_same(placed, hit, [*ks, "_cell"]).groupBy(*ks, "_cell", "_v").agg(
        F.count(F.lit(1)).alias("_n"), F.first("_below").alias("_start"), F.first("_ranks").alias("_ranks"))
    smaller = Window.partitionBy(*ks, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_start") + F.coalesce(F.sum("_n").over(smaller), F.lit(0))
    inside = inside.withColumn("_below", below)
    at_rank = inside.select(*ks, "_v", F.explode(_ranks_between(F.col("_ranks"), F.col("_below"), F.col("_n"))).alias("_rank"))
    values = at_rank.groupBy(*ks).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))

    out = _join_same(stats, values, ks, "left")
    names = ["p0", "p25", "p50", "p75", "p100"]
    return out.select(*[F.col(a).alias(k) for k, a in zip(keys, ks)],
                      *[_interpolated(F.col("_at"), p).alias(name) for name, p in zip(names, place)], "mean", "std", "n")


def _interpolated(at: Column, place: Column) -> Column:
    """The value at a fractional rank, from the map of values at whole ranks."""
    low, high = F.floor(place).cast("long"), F.ceil(place).cast("long")
    below, above = F.try_element_at(at, low), F.try_element_at(at, high)
    return F.when(below == above, below).otherwise((high - place) * below + (place - low) * above)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """float/integer columns in schema order."""
    ok = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, ok) and f.name not in exclude]


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair below the diagonal (i > j), pairwise complete.

    One aggregate gives the column means, by which values are shifted, so the
    moments stay exact where the mean is large against the spread.  Each
    partition then reduces its rows to one row of moment sums per pair, over the
    rows in which both values are present (NaN counts as missing); only those
    rows are shuffled.  A pair with fewer than two rows or without spread gives
    null.
    """
    cols = list(cols)
    m = len(cols)
    value = [F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols]
    means = df.agg(*[F.coalesce(F.avg(v), F.lit(0.0)).alias(f"m{k}") for k, v in enumerate(value)]).first()
    shifted = df.select(*[(v - F.lit(means[k])).alias(f"v{k}") for k, v in enumerate(value)])
    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")
    first, second = np.array([(i, j) for i in range(m) for j in range(i)], dtype=int).reshape(-1, 2).T

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(first)))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) if batch.num_rows else np.zeros((m, 0))
            here = ~np.isnan(x)
            x, here = np.where(here, x, 0.0), here.astype(float)
            one, two = x @ here.T, (x * x) @ here.T  # sums of column i over the rows that have column j
            total += [(here @ here.T)[first, second], one[first, second], one[second, first],
                      two[first, second], two[second, first], (x @ x.T)[first, second]]
        yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), *map(pa.array, total)], names=["i", "j", *sums])

    parts = shifted.mapInArrow(moments, "i long, j long, " + ", ".join(f"{c} double" for c in sums))
    t = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    over = lambda a, b, ab: F.col(ab) - F.try_divide(F.col(a) * F.col(b), F.col("n"))
    spread = F.sqrt(F.greatest(over("sx", "sx", "sxx"), F.lit(0.0)) * F.greatest(over("sy", "sy", "syy"), F.lit(0.0)))
    names = F.array(*map(F.lit, cols))
    return t.select(F.get(names, F.col("i").cast("int")).alias("col_a"), F.get(names, F.col("j").cast("int")).alias("col_b"),
                    F.when(F.col("n") > 1, F.try_divide(over("sx", "sy", "sxy"), spread)).alias("corr"))


def tail_per_asset(df: DataFrame, n: int, order: Sequence[Column], key: str = "asset_name",
                   newest_first: bool = True) -> DataFrame:
    """Last (or first) ``n`` rows per asset; ``rank`` 1 is the newest (oldest).

    ``n`` is a literal, so Spark plans WindowGroupLimit: map tasks forward at
    most ``n`` rows per asset before the shuffle.
    """
    ordering = [c.desc() for c in order] if newest_first else [c.asc() for c in order]
    return top_k_per_group(df, [key], ordering, n, "rank")
