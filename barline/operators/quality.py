"""Data-quality checks as one aggregate pass per dataset.

Check order and pass rules follow the source validator: not-empty, required
columns, numeric types, null ratio (≤ max; an empty table fails), duplicates
on the existing key columns (rows beyond the first, nulls equal), and no
negative values among non-null entries.  A check whose column is absent (or,
for the sign check, entirely null) is not emitted at all.

Every statistic of a dataset comes from one scan: aggregated per duplicate key
(map-side partial aggregation) and summed, or observed while the dataset is
written.  Check rows come from ``stack``.
Nothing is collected but those metrics, one number each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.session import materialize

CHECK_SCHEMA = "dataset string, check_id int, check_name string, passed boolean, observed double"


@dataclass(frozen=True)
class DatasetRules:
    required_columns: tuple[str, ...]
    numeric_columns: tuple[str, ...]
    max_null_ratio: float = 0.1
    duplicate_keys: tuple[str, ...] = ("timestamp", "name")


# fixed rule sets of the source validator
STOCK_RULES = DatasetRules(("timestamp", "name", "last"), ("last", "high", "low", "vol"), 0.1)
CRYPTO_RULES = DatasetRules(("timestamp", "name", "price_usd"), ("price_usd", "vol_24h", "market_cap"), 0.1)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows beyond the first per key (null keys compare equal, as in groupBy)."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_dupes"),
             F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"))
    )


def _columns(df: DataFrame, rules: DatasetRules) -> tuple[list[str], list[str]]:
    """The rules' numeric columns that ``df`` has, and those of them that are numeric."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in rules.numeric_columns if c in types]
    return present, [c for c in present if isinstance(types[c], T.NumericType)]


def _keys(df: DataFrame, rules: DatasetRules) -> list[str]:
    return [k for k in rules.duplicate_keys if k in df.columns]


def _statistics(df: DataFrame, rules: DatasetRules) -> list[Column]:
    """The aggregates the checks need: row count, nulls, and negatives and values of numeric columns."""
    present, numeric = _columns(df, rules)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(present):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"null_{i}"))
        if c in numeric:
            aggs += [F.count_if(F.col(c) < 0).alias(f"neg_{i}"), F.count(F.col(c)).alias(f"nn_{i}")]
    return aggs


def validate_dataset(df: DataFrame, rules: DatasetRules, name: str) -> DataFrame:
    """All checks of one dataset as rows (dataset, check_id, check_name, passed, observed).

    One scan: the statistics are taken per duplicate key, then summed, so the
    shuffle that finds the duplicates carries them along.  ``write_checked`` takes
    the same checks while the dataset is written.
    """
    keys = _keys(df, rules)
    stats = _statistics(df, rules)
    if not keys:
        return _check_rows(df, df.agg(*stats), rules, name)
    per_key = df.groupBy(*[F.col(_q(k)).alias(f"key_{i}") for i, k in enumerate(keys)]).agg(*stats)
    totals = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in per_key.columns[len(keys):]]
    return _check_rows(df, per_key.agg(*totals, F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_dupes")), rules, name)


def write_checked(df: DataFrame, rules: DatasetRules, name: str) -> tuple[DataFrame, DataFrame]:
    """A9 in the scan that writes the dataset: (the written table, its checks as by ``validate_dataset``).

    The statistics are metrics observed by the writing tasks: they sit above
    every shuffle of ``df``, in the stage whose tasks count once each however
    often they are tried.  The duplicate count then reads the key columns of the
    written table; ``df`` itself is computed once.  The table lies in the
    checkpoint folder.
    """
    seen = Observation()
    table = materialize(df.observe(seen, *_statistics(df, rules)), f"checked-{name}")
    present, numeric = _columns(df, rules)
    metrics = ["n", *[f"null_{i}" for i in range(len(present))],
               *[f"{m}_{i}" for i, c in enumerate(present) if c in numeric for m in ("neg", "nn")]]
    found = seen.get  # one number a metric; none where the plan is known to be empty
    stats = [F.lit(int(found.get(m) or 0)).alias(m) for m in metrics]
    keys = _keys(df, rules)
    one = duplicate_count(table, keys).select("n_dupes", *stats) if keys else df.sparkSession.range(1).select(*stats)
    return table, _check_rows(table, one, rules, name)


def _check_rows(df: DataFrame, stats: DataFrame, rules: DatasetRules, name: str) -> DataFrame:
    """The checks as rows, from the one-row frame of ``_statistics`` and its ``n_dupes``."""
    present, numeric = _columns(df, rules)
    missing = [c for c in rules.required_columns if c not in df.columns]

    rows = []  # (id, name, passed-expr, observed-expr, emit-expr)
    cid = 0

    def add(check: str, passed: str, observed: str, emit: str = "true"):
        nonlocal cid
        cid += 1
        rows.append((cid, check, passed, observed, emit))

    add("DataFrame not empty", "n > 0", "CAST(n AS DOUBLE)")
    add("Required columns present", "true" if not missing else "false", f"CAST({len(missing)} AS DOUBLE)")
    for c in present:
        ok = c in numeric
        add(f"Column '{c}' is numeric", "true" if ok else "false", "1.0D" if ok else "0.0D")
    for i, c in enumerate(present):
        ratio = f"try_divide(CAST(null_{i} AS DOUBLE), CAST(n AS DOUBLE))"
        add(f"Null ratio for '{c}'", f"coalesce({ratio} <= {float(rules.max_null_ratio)!r}D, false)", ratio)
    keys = _keys(df, rules)
    if keys:
        add("No duplicates on [" + ", ".join(f"'{k}'" for k in keys) + "]", "n_dupes = 0", "CAST(n_dupes AS DOUBLE)")
    for i, c in enumerate(present):
        if c in numeric:
            add(f"Column '{c}' has no negative values", f"neg_{i} = 0", f"CAST(neg_{i} AS DOUBLE)", f"nn_{i} > 0")

    body = ", ".join(f"{i}, {_lit(n)}, {p}, {o}, {e}" for i, n, p, o, e in rows)
    out = stats.selectExpr(f"stack({len(rows)}, {body}) AS (check_id, check_name, passed, observed, emit)")
    return out.where("emit").select(
        F.lit(name).alias("dataset"), F.col("check_id").cast("int"), "check_name",
        F.col("passed").cast("boolean"), F.col("observed").cast("double"))


def overall(checks: DataFrame) -> DataFrame:
    """Per dataset: passed = AND of all checks, with counts."""
    return checks.groupBy("dataset").agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
    )


def duplicates_report(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A7 as a report row: dataset, keys, n_rows, n_dupes, passed (absent keys → no row)."""
    existing = [k for k in keys if k in df.columns]
    if not existing:
        return df.sparkSession.createDataFrame([], "dataset string, keys string, n_rows long, n_dupes long, passed boolean")
    return duplicate_count(df, existing).select(
        F.lit(name).alias("dataset"), F.lit(",".join(existing)).alias("keys"),
        "n_rows", "n_dupes", (F.col("n_dupes") == 0).alias("passed"))


def missing_assets(configured: DataFrame, observed: DataFrame, key: str = "asset_name") -> DataFrame:
    """configured assets that never occur in ``observed``.

    ``observed`` is reduced to its distinct keys first (partial aggregation),
    so the anti join only ever sees one row per asset.
    """
    present = observed.select(key).distinct()
    return configured.join(present, key, "left_anti")
