"""Order-dependent operators that stay safe when one key holds much of the data.

A plain ``Window.partitionBy(asset).orderBy(ts)`` sends every row of an asset
to one task.  On raw event tables an asset can hold a third of all rows, so
``lag`` of any distance, forward fill and ``row_number`` over raw rows are
computed *block-wise*:

1. rows are windowed inside ``(keys, block)`` where ``block`` is monotone in
   the order (normally the calendar day of the timestamp);
2. a per-block summary (last value / row count) is aggregated with map-side
   partial aggregation — its size is keys x blocks, independent of row count;
3. a window over that small summary carries values across block boundaries;
4. the carry is joined back on ``(keys, block)``; the big side is already
   hash-partitioned on those keys by step 1, so only the summary moves.

The block is a parameter: where a single asset-day is itself hot, a finer
monotone block (``date_trunc('hour', ts)``, or minutes) spreads it over more
tasks; the summary grows only to keys x blocks.

Series that are already daily (one row per asset and day) are bounded by the
calendar, and ordinary windows over ``asset`` are used for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.ordering import order_key


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in names]


def blocked_lag(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str],
                values: Sequence[str], suffix: str = "_prev") -> DataFrame:
    """Add ``<value><suffix>`` = value of the previous row in ``order`` within ``keys``.

    ``block`` must be a column of ``df`` that never decreases along ``order``
    (e.g. ``to_date(ts)``); ties in ``order`` must be broken by a unique column.
    """
    keys, order, values = list(keys), list(order), list(values)
    w_in = Window.partitionBy(*keys, block).orderBy(*_cols(order))
    local = df.withColumn("_rn_in_block", F.row_number().over(w_in))
    for v in values:
        local = local.withColumn(v + suffix, F.lag(v).over(w_in))

    last = order_key(df, order[0], order[1]) if len(order) == 2 else F.struct(*_cols(order))
    tails = df.groupBy(*keys, block).agg(*[F.max_by(v, last).alias("_tail_" + v) for v in values])
    w_blk = Window.partitionBy(*keys).orderBy(block)
    carry = tails.select(*keys, block, *[F.lag("_tail_" + v).over(w_blk).alias("_carry_" + v) for v in values])

    out = local.join(carry, [*keys, block], "left")
    for v in values:
        out = out.withColumn(
            v + suffix,
            F.when(F.col("_rn_in_block") == 1, F.col("_carry_" + v)).otherwise(F.col(v + suffix)),
        )
    return out.drop("_rn_in_block", *["_carry_" + v for v in values])


def blocked_row_number(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str],
                       out: str = "row_number") -> DataFrame:
    """Add a 1-based ``row_number`` over ``keys`` ordered by ``order``, block-wise."""
    keys, order = list(keys), list(order)
    w_in = Window.partitionBy(*keys, block).orderBy(*_cols(order))
    local = df.withColumn("_rn_in_block", F.row_number().over(w_in))

    counts = df.groupBy(*keys, block).agg(F.count(F.lit(1)).alias("_n"))
    w_blk = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, block, F.coalesce(F.sum("_n").over(w_blk), F.lit(0)).alias("_offset"))

    return (
        local.join(offsets, [*keys, block], "left")
        .withColumn(out, F.col("_rn_in_block") + F.col("_offset"))
        .drop("_rn_in_block", "_offset")
    )


def _carry_back(local: DataFrame, carry: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of per-block values; null keys are equal."""
    there = [f"_on_{i}" for i in range(len(on))]
    carry = carry.withColumnsRenamed(dict(zip(on, there)))
    return local.join(carry, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(on, there)], "left").drop(*there)


def blocked_shift(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str],
                  values: Sequence[str], k: int, suffix: str = "_prev") -> DataFrame:
    """Add ``<value><suffix>`` = value ``k`` rows before in ``order`` within ``keys`` (null in the first ``k`` rows).

    ``lag(k)`` inside a block; the first ``k`` rows of a block take theirs from the last ``k`` rows
    of the blocks before it.  Every block hands on its last (at most ``k``) values, and as each has
    a row, the ``k`` blocks before always hold them: the window over the summary looks back ``k`` rows.
    """
    keys, order, values = list(keys), list(order), list(values)
    line = Window.partitionBy(*keys, block).orderBy(*_cols(order))
    local = df.withColumns({
        "_rn": F.row_number().over(line), "_end": F.lead(F.lit(1)).over(line).isNull(),
        "_tail": F.collect_list(F.struct(*_cols(values))).over(line.rowsBetween(-(k - 1), 0)),
        **{v + suffix: F.lag(v, k).over(line) for v in values}})
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(-k, -1)
    tails = local.where("_end").select(*keys, block, F.flatten(F.collect_list("_tail").over(before)).alias("_carry"))
    out = _carry_back(local, tails, [*keys, block])
    # the carry's last element is one row before the block's first
    handed = F.get("_carry", F.size("_carry") - F.lit(k + 1) + F.col("_rn"))
    out = out.withColumns({v + suffix: F.when(F.col("_rn") > k, F.col(v + suffix)).otherwise(handed[v]) for v in values})
    return out.drop("_rn", "_end", "_tail", "_carry")


def blocked_ffill(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], values: Sequence[str],
                  suffix: str = "_filled") -> DataFrame:
    """Add ``<value><suffix>`` = the last non-null value up to the row in ``order`` within ``keys``."""
    keys, order, values = list(keys), list(order), list(values)
    line = Window.partitionBy(*keys, block).orderBy(*_cols(order))
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({"_end": F.lead(F.lit(1)).over(line).isNull(),
                            **{v + suffix: F.last(v, ignorenulls=True).over(upto) for v in values}})
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    tails = local.where("_end").select(*keys, block, *[
        F.last(v + suffix, ignorenulls=True).over(before).alias("_carry_" + v) for v in values])
    out = _carry_back(local, tails, [*keys, block])
    out = out.withColumns({v + suffix: F.coalesce(v + suffix, "_carry_" + v) for v in values})
    return out.drop("_end", *["_carry_" + v for v in values])


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    out: str = "rank") -> DataFrame:
    """Rows with ``row_number <= k`` per group.

    The literal ``k`` lets Catalyst plan a WindowGroupLimit below the shuffle,
    so each map task forwards at most ``k`` rows per group (hot groups stay cheap).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= F.lit(k))
