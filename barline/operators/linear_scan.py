"""Exponential moving averages of long series, as a blocked scan of affine maps.

``e' = (1 - a) * e + a * x`` is an affine map of the state, and maps compose:
a stretch of rows takes any state in to ``W * in + L``.  So no task has to walk
a whole series:

1. rows are grouped by (keys, block of ``width`` positions), and each block is
   folded to its map;
2. the maps are composed, block after block, to the state that enters each
   block: by one window per key (``levels=1``), or first inside groups of
   ``width`` blocks and then over the groups (once more for every level);
3. the entering state is applied inside the block, and the rows come back out.

With ``levels=0``, for series that a calendar bounds, no maps are made: the blocks of
one key meet in one task, and the recursion runs through them once.  Its values are
those of a row-by-row loop to the last bit, so equal averages in flat stretches stay
equal, which rank statistics on them need.  No join is planned.  With more levels only
the maps meet,
one row for every ``width`` rows, and their groups; a key that holds most of the
rows is spread over as many tasks as it has blocks.  All of it is in Catalyst:
aggregates, windows and higher-order functions.

Conventions: seeded with the first observation, no bias adjustment; a null is no
observation and leaves the state as it is.  Null keys are a key of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 64


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def joined(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on columns of the same names, nulls equal; ``right``'s copies of them go."""
    there = {c: f"_on_{c}" for c in on}
    renamed = right.select(*[F.col(c).alias(there.get(c, c)) for c in right.columns])
    return left.join(renamed, [F.col(c).eqNullSafe(F.col(there[c])) for c in on], "left").drop(*there.values())


@dataclass(frozen=True)
class Average:
    """One moving average: its value column, weight of a new observation, and fewest observations to show."""

    value: str
    alpha: float
    fewest: int = 1

    def step(self, state: str, row: str) -> str:
        """SQL of the state after a row."""
        v = f"CAST({row}.`{self.value}` AS DOUBLE)"
        mixed = f"{state} * {1.0 - self.alpha!r}D + {v} * {float(self.alpha)!r}D"
        # the first observation is the first state, and an unchanged value stays as it is to the last bit
        return f"CASE WHEN {v} IS NULL OR {state} = {v} THEN {state} WHEN {state} IS NULL THEN {v} ELSE {mixed} END"

    def one(self, row: str, then: str, otherwise: str) -> str:
        """SQL choosing by whether the row is an observation."""
        return f"IF({row}.`{self.value}` IS NULL, {otherwise}, {then})"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {f}" for n, f in fields.items()) + ")"


# the map of a stretch of rows, for one average: state -> w * state + l; n observations, the first of them x
IDENTITY = _struct(w="1.0D", l="0.0D", n="0L", x="CAST(NULL AS DOUBLE)")


def _block_map(series: Mapping[str, Average]) -> Column:
    """The maps of a block, from its rows in order."""
    step = _struct(**{n: _struct(
        w=a.one("r", f"s.{n}.w * {1.0 - a.alpha!r}D", f"s.{n}.w"), l=a.step(f"s.{n}.l", "r"), n=a.one("r", f"s.{n}.n + 1L", f"s.{n}.n"),
        x=f"coalesce(s.{n}.x, CAST(r.`{a.value}` AS DOUBLE))") for n, a in series.items()})
    return F.expr(f"aggregate(_rows, {_struct(**dict.fromkeys(series, IDENTITY))}, (s, r) -> {step})")


def _inside(series: Mapping[str, Average]) -> Column:
    """The averages after each row of a block, from the state that enters it (_in: e and n by name)."""
    after = _struct(**{n: _struct(e=a.step(f"s.s.{n}.e", "r"), n=a.one("r", f"s.s.{n}.n + 1L", f"s.s.{n}.n")) for n, a in series.items()})
    kind = "struct<" + ",".join(f"{n}:struct<e:double,n:bigint>" for n in series) + ">"
    start = _struct(s=f"CAST(_in AS {kind})", out=f"CAST(array() AS array<{kind}>)")
    step = f"(s, r) -> transform(array({after}), t -> {_struct(s='t', out='concat(s.out, array(t))')})[0]"
    return F.expr(f"aggregate(_rows, {start}, {step}, s -> s.out)")


def replayed(blocks: DataFrame, keys: Sequence[str], block: str, series: Mapping[str, Average]) -> DataFrame:
    """(keys, block, _rows, _in): the entering states by the recursion itself, block after block, once over a key's rows."""
    after = _struct(**{n: _struct(e=a.step(f"s.{n}.e", "r"), n=a.one("r", f"s.{n}.n + 1L", f"s.{n}.n")) for n, a in series.items()})
    kind = "struct<" + ",".join(f"{n}:struct<e:double,n:bigint>" for n in series) + ">"
    start = _struct(**{n: _struct(e="CAST(NULL AS DOUBLE)", n="0L") for n in series})
    step = _struct(s=f"aggregate(b._rows, t.s, (s, r) -> {after})", out="concat(t.out, array(t.s))")
    series_of = blocks.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(block, "_rows"))).alias("_blocks"))
    begin = _struct(s=f"CAST({start} AS {kind})", out=f"CAST(array() AS array<{kind}>)")
    states = series_of.withColumn("_states", F.expr(f"aggregate(_blocks, {begin}, (t, b) -> {step}, t -> t.out)"))
    flat = states.select(*keys, F.inline(F.arrays_zip("_blocks", "_states")))
    return flat.select(*keys, F.col(f"_blocks.{block}").alias(block), F.col("_blocks._rows").alias("_rows"), F.col("_states").alias("_in"))


def entering(blocks: DataFrame, keys: Sequence[str], block: str, names: Sequence[str], width: int, levels: int) -> DataFrame:
    """``blocks`` with ``_in``, the state e and the number of observations n before each block, by name, from ``_map``."""
    if "_rows" in blocks.columns:
        return joined(blocks, entering(blocks.select(*keys, block, "_map"), keys, block, names, width, levels).drop("_map"), [*keys, block])
    if levels == 0:
        line = Window.partitionBy(*keys).orderBy(block)
        before = line.rowsBetween(Window.unboundedPreceding, -1)
        whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        # before any observation the state is the first one
        seeds = {f"_seed_{n}": F.first(F.expr(f"_map.{n}.x"), ignorenulls=True).over(whole) for n in names}
        seeded = blocks.withColumns({"_maps": F.collect_list("_map").over(before)} | seeds)
        start = _struct(**{n: _struct(e=f"_seed_{n}", n="0L") for n in names})
        step = _struct(**{n: _struct(e=f"s.{n}.e * m.{n}.w + m.{n}.l", n=f"s.{n}.n + m.{n}.n") for n in names})
        return seeded.withColumn("_in", F.expr(f"aggregate(_maps, {start}, (s, m) -> {step})")).drop("_maps", *seeds)
    upper = block + "_up"
    groups = blocks.select(*keys, block, "_map").withColumn(upper, F.floor(F.col(block) / width))
    groups = groups.groupBy(*keys, upper).agg(F.sort_array(F.collect_list(F.struct(block, "_map"))).alias("_blocks"))
    # the map of all earlier blocks of the group before each block, and of the whole group at the end
    last = "element_at(s, -1)"
    both = _struct(**{n: _struct(w=f"{last}.{n}.w * m._map.{n}.w", l=f"{last}.{n}.l * m._map.{n}.w + m._map.{n}.l",
                                 n=f"{last}.{n}.n + m._map.{n}.n", x=f"coalesce({last}.{n}.x, m._map.{n}.x)") for n in names})
    none = _struct(**dict.fromkeys(names, IDENTITY))
    groups = groups.withColumn("_pre", F.expr(f"aggregate(_blocks, array({none}), (s, m) -> concat(s, array({both})))"))
    groups = groups.withColumn("_map", F.element_at("_pre", -1))
    solved = entering(groups, keys, upper, names, width, levels - 1)
    state = _struct(**{n: _struct(e=f"_in.{n}.e * _pre[i].{n}.w + _pre[i].{n}.l", n=f"_in.{n}.n + _pre[i].{n}.n") for n in names})
    states = F.expr(f"inline(transform(_blocks, (b, i) -> named_struct('{block}', b.{block}, '_in', {state})))")
    return joined(blocks, solved.select(*keys, states), [*keys, block])


def ema_scan(df: DataFrame, keys: Sequence[str], pos: Column, series: Mapping[str, Average],
             width: int = WIDTH, levels: int = 0) -> DataFrame:
    """``df`` with one column per item of ``series`` (names of letters, digits and underscores).

    ``pos`` is a whole number that orders the rows of a key, unique within it (e.g. the day's
    number); a block is ``width`` consecutive positions.  An average is null until its fewest
    observations are seen, and before the first one.
    """
    keys, names = list(keys), list(series)
    rest = [c for c in df.columns if c not in keys]
    rows = df.select(*keys, *rest, pos.cast("long").alias("_pos")).withColumn("_block", F.floor(F.col("_pos") / width))
    blocks = rows.groupBy(*keys, "_block").agg(F.sort_array(F.collect_list(F.struct("_pos", *rest))).alias("_rows"))
    if levels == 0:
        solved = replayed(blocks, keys, "_block", series)
    else:
        solved = entering(blocks.withColumn("_map", _block_map(series)), keys, "_block", names, width, levels - 1)
    told = solved.withColumn("_out", _inside(series)).select(*keys, F.inline(F.arrays_zip("_rows", "_out")))
    shown = {n: F.expr(f"IF(_out.{n}.n >= {max(1, a.fewest)}, _out.{n}.e, NULL)").alias(n) for n, a in series.items()}
    place = {c: F.col(c) for c in keys} | {c: F.col("_rows")[c].alias(c) for c in rest} | shown
    return told.select(*[place[c] for c in [*df.columns, *names]])
