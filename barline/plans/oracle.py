"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written against the driver's pre-registered tables and re-derives
each fixture view itself.  It deliberately uses *different* algorithms from the
Spark side where one exists (calendar join + ``last_value IGNORE NULLS``
instead of lead/explode, a recursive CTE for the EMA recursion instead of the
truncated fold, ``regr_slope`` instead of a Gram solve).
"""

from __future__ import annotations

from barline.config import FeatureConfig
from barline.operators.linear_scan import span_alpha

ROUND = 4


def dlit(x: float) -> str:
    """A DOUBLE literal that parses to exactly ``x``."""
    if x == float("inf"):
        return "CAST('Infinity' AS DOUBLE)"
    if x == float("-inf"):
        return "CAST('-Infinity' AS DOUBLE)"
    return f"CAST('{x!r}' AS DOUBLE)"


def r(expr: str, digits: int = ROUND) -> str:
    return f"round({expr}, {digits})"


# ---------------------------------------------------------------- views ----
VIEWS: dict[str, str] = {}

VIEWS["prices"] = """
SELECT o_orderpriority AS asset_name,
       CASE WHEN o_orderpriority < '3' THEN 'stock' ELSE 'crypto' END AS asset_type,
       CAST(o_orderdate AS TIMESTAMP) AS ts, o_orderkey AS tie, o_totalprice AS price
FROM orders"""

VIEWS["daily_obs"] = """
SELECT asset_name, asset_type, CAST(ts AS DATE) AS day, arg_max(price, row(ts, tie)) AS close
FROM prices WHERE price IS NOT NULL GROUP BY ALL"""

VIEWS["daily"] = """
SELECT c.asset_name, c.asset_type, c.day,
       last_value(o.close IGNORE NULLS) OVER (PARTITION BY c.asset_name ORDER BY c.day
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close
FROM (SELECT asset_name, asset_type,
             CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP),
                                         INTERVAL 1 DAY)) AS DATE) AS day
      FROM daily_obs GROUP BY asset_name, asset_type) c
LEFT JOIN daily_obs o ON o.asset_name = c.asset_name AND o.day = c.day"""

VIEWS["bars"] = """
SELECT event_type AS asset_name, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp,
       arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, row(ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY ALL"""

VIEWS["dirty"] = """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice,
       CASE o_orderkey % 10
         WHEN 0 THEN '$' || CAST(o_custkey AS VARCHAR) || ',000.5'
         WHEN 1 THEN CAST(o_custkey AS VARCHAR) || '.25M'
         WHEN 2 THEN CAST(o_custkey AS VARCHAR) || 'b'
         WHEN 3 THEN CAST(o_custkey AS VARCHAR) || '.5%'
         WHEN 4 THEN 'nan'
         WHEN 5 THEN NULL
         WHEN 6 THEN 'invalidM'
         WHEN 7 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
         WHEN 8 THEN '-' || CAST(o_custkey AS VARCHAR) || '.75'
         ELSE CAST(o_custkey AS VARCHAR) || 'K' END AS raw
FROM orders"""

VIEWS["preds"] = """
SELECT * FROM (
  SELECT asset_name, ts, tie, price AS y_true,
         lag(price) OVER (PARTITION BY asset_name ORDER BY ts, tie) AS y_pred
  FROM prices) WHERE y_pred IS NOT NULL"""

VIEWS["runs"] = """
SELECT o_orderkey AS run_id, 'm_' || o_orderpriority AS model_name,
       CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
       CAST(o_orderdate AS TIMESTAMP) AS start_time,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / CAST(10 AS DOUBLE) END AS rmse,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice / CAST(12.5 AS DOUBLE) END AS mae
FROM orders"""

VIEWS["versions"] = """
SELECT 'm_' || o_orderpriority AS model_name,
       CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS VARCHAR)
         AS version,
       o_orderkey AS run_id
FROM orders"""

VIEWS["aliases"] = """
SELECT model_name, 'Champion' AS alias,
       CAST(CASE WHEN model_name LIKE 'm_2%' THEN max(CAST(version AS BIGINT)) ELSE 1 END AS VARCHAR)
         AS version
FROM versions WHERE model_name NOT LIKE 'm_5%' GROUP BY model_name"""

VIEWS["request_events"] = """
SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / (1 + user_id % 8)) AS BIGINT) AS period FROM events"""

VIEWS["request_periods"] = """
SELECT user_id, unnest(range(min(period), max(period) + 1)) AS at_period FROM request_events GROUP BY user_id"""

# every period between a user's first and last one; some are sent again, with half of the text
VIEWS["request_users"] = """
SELECT user_id, at_period, CASE WHEN bad THEN -1 - (user_id * 1000 + at_period) ELSE user_id * 1000 + at_period END AS request_id,
       CASE WHEN user_id % 6 = 5 THEN 'unknown' ELSE 'known' END AS asset_name, bad
FROM (SELECT *, false AS bad FROM request_periods
      UNION ALL SELECT *, true FROM request_periods WHERE (user_id + at_period) % 23 = 0)"""

VIEWS["requests_flat"] = """
SELECT u.request_id, u.asset_name, e.ts, e.event_id, e.event_type, e.value AS close,
       CAST(regexp_extract(e.props, '"k": *([0-9.]+)', 1) AS DOUBLE) AS k
FROM request_users u JOIN request_events e ON e.user_id = u.user_id AND e.period = u.at_period WHERE NOT u.bad"""

# views each view depends on (transitively resolved by ``with_views``)
DEPS = {
    "daily_obs": ["prices"], "daily": ["daily_obs"], "preds": ["prices"],
    "aliases": ["versions"], "request_periods": ["request_events"], "request_users": ["request_periods"], "requests_flat": ["request_users"],
}


def _resolve(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views: list[str], ctes: list[tuple[str, str]], final: str, recursive: bool = False) -> str:
    parts = [f"{n} AS ({VIEWS[n]})" for n in _resolve(views)]
    parts += [f"{n} AS ({body})" for n, body in ctes]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + final


# ------------------------------------------------------- indicator SQL ----
def ema_recursive_ctes(cfg: FeatureConfig) -> list[tuple[str, str]]:
    """EMA family by exact recursion (one recursive CTE per chain)."""
    af, as_, ag = span_alpha(cfg.macd_fast), span_alpha(cfg.macd_slow), span_alpha(cfg.macd_signal)
    ar = 1.0 / cfg.rsi_window

    def step(prev: str, x: str, a: float) -> str:
        return f"CASE WHEN {prev} = {x} THEN {prev} ELSE {prev} * {dlit(1.0 - a)} + {x} * {dlit(a)} END"

    base = """
SELECT asset_name, day, close, row_number() OVER w AS rn,
       CASE WHEN lag(close) OVER w IS NULL THEN CAST(0 AS DOUBLE)
            ELSE greatest(close - lag(close) OVER w, CAST(0 AS DOUBLE)) END AS gain,
       CASE WHEN lag(close) OVER w IS NULL THEN CAST(0 AS DOUBLE)
            ELSE greatest(lag(close) OVER w - close, CAST(0 AS DOUBLE)) END AS loss
FROM daily WINDOW w AS (PARTITION BY asset_name ORDER BY day)"""
    rec = f"""
SELECT asset_name, rn, close AS ef, close AS es, gain AS eu, loss AS ed FROM ind_base WHERE rn = 1
UNION ALL
SELECT b.asset_name, b.rn, {step('e.ef', 'b.close', af)}, {step('e.es', 'b.close', as_)},
       {step('e.eu', 'b.gain', ar)}, {step('e.ed', 'b.loss', ar)}
FROM ema_chain e JOIN ind_base b ON b.asset_name = e.asset_name AND b.rn = e.rn + 1"""
    macd = f"""
SELECT asset_name, rn, CASE WHEN rn >= {cfg.macd_slow} THEN ef - es END AS macd,
       CASE WHEN rn >= {cfg.macd_fast} THEN ef END AS ema_fast,
       CASE WHEN rn >= {cfg.macd_slow} THEN es END AS ema_slow,
       CASE WHEN rn < {cfg.rsi_window} THEN NULL
            WHEN ed = 0 THEN CAST(100 AS DOUBLE)
            ELSE 100 - 100 / (1 + eu / ed) END AS rsi
FROM ema_chain"""
    sig = f"""
SELECT asset_name, rn, macd AS es FROM ema_macd WHERE rn = {cfg.macd_slow}
UNION ALL
SELECT m.asset_name, m.rn, {step('s.es', 'm.macd', ag)}
FROM signal_chain s JOIN ema_macd m ON m.asset_name = s.asset_name AND m.rn = s.rn + 1"""
    return [("ind_base", base), ("ema_chain", rec), ("ema_macd", macd), ("signal_chain", sig)]


def indicator_select(cfg: FeatureConfig, rounded: bool = True) -> tuple[list[tuple[str, str]], str]:
    """CTEs + a SELECT producing every indicator column from ``daily``."""
    w = "PARTITION BY d.asset_name ORDER BY d.day"

    def roll(fn: str, n: int) -> str:
        return f"CASE WHEN d.rn >= {n} THEN {fn}(d.close) OVER (w ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END"

    n = cfg.bollinger_window
    dev = dlit(float(cfg.bollinger_dev))
    cols = {
        "return": "d.close / lag(d.close) OVER w - 1",
        "log_return": "ln(d.close / lag(d.close) OVER w)",
    }
    for m in cfg.moving_averages:
        cols[f"ma_{m}"] = roll("avg", m)
    cols["macd"] = "m.macd"
    cols["macd_signal"] = f"CASE WHEN m.rn >= {cfg.macd_slow + cfg.macd_signal - 1} THEN s.es END"
    cols["macd_diff"] = f"m.macd - (CASE WHEN m.rn >= {cfg.macd_slow + cfg.macd_signal - 1} THEN s.es END)"
    cols["rsi"] = "m.rsi"
    cols["bb_high"] = f"{roll('avg', n)} + {dev} * ({roll('stddev_pop', n)})"
    cols["bb_low"] = f"{roll('avg', n)} - {dev} * ({roll('stddev_pop', n)})"
    cols[f"volatility_{cfg.volatility_window}"] = roll("stddev_samp", cfg.volatility_window)
    for k in cfg.lags:
        cols[f"lag_{k}"] = f"lag(d.close, {k}) OVER w"
    cols["target"] = "lead(d.close, 1) OVER w"
    inner = ",\n  ".join(f'{v} AS "{k}"' for k, v in cols.items())
    ctes = ema_recursive_ctes(cfg)
    ctes.append(("ind_raw", f"""
SELECT d.asset_name, d.asset_type, d.day, d.close, {inner}
FROM (SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY day) AS rn FROM daily) d
JOIN ema_macd m ON m.asset_name = d.asset_name AND m.rn = d.rn
LEFT JOIN signal_chain s ON s.asset_name = d.asset_name AND s.rn = d.rn
WINDOW w AS ({w})"""))
    ctes.append(("ind", """
SELECT *, (bb_high - bb_low) / nullif(close, 0) AS bb_width,
          (close - bb_low) / nullif(bb_high - bb_low, 0) AS bb_position
FROM ind_raw"""))
    return ctes, "ind"


# ---------------------------------------------------------- cleaning SQL ----
FLOAT_RE = r"^[+-]?(?:[0-9](?:_?[0-9])*(?:\.(?:[0-9](?:_?[0-9])*)?)?|\.[0-9](?:_?[0-9])*)(?:[eE][+-]?[0-9](?:_?[0-9])*)?$"
INF_RE = r"^[+-]?(?:INF|INFINITY)$"


def sql_parse_float(t: str) -> str:
    t = f"regexp_replace({t}, '^\\s+|\\s+$', '', 'g')"
    return (f"CASE WHEN regexp_matches({t}, '{FLOAT_RE}') THEN CAST(replace({t}, '_', '') AS DOUBLE) "
            f"WHEN regexp_matches({t}, '{INF_RE}') THEN "
            f"(CASE WHEN starts_with({t}, '-') THEN {dlit(float('-inf'))} ELSE {dlit(float('inf'))} END) END")


def sql_clean_numeric(x: str) -> str:
    s = f"upper(regexp_replace(regexp_replace(CAST({x} AS VARCHAR), '[$,\"]', '', 'g'), '^\\s+|\\s+$', '', 'g'))"
    return (f"CASE WHEN {s} IS NULL THEN NULL "
            f"WHEN contains({s}, 'M') THEN ({sql_parse_float(f'replace({s}, ' + chr(39) + 'M' + chr(39) + ', ' + chr(39) + chr(39) + ')')}) * {dlit(1e6)} "
            f"WHEN contains({s}, 'B') THEN ({sql_parse_float(f'replace({s}, ' + chr(39) + 'B' + chr(39) + ', ' + chr(39) + chr(39) + ')')}) * {dlit(1e9)} "
            f"ELSE {sql_parse_float(f'replace({s}, ' + chr(39) + '%' + chr(39) + ', ' + chr(39) + chr(39) + ')')} END")


VIEWS["raw_bars"] = """
SELECT asset_name AS "Ticker", timestamp AS "Datetime", open AS "Open", high AS "High", low AS "Low",
       close AS "Close", volume AS "Volume" FROM bars"""

VIEWS["raw_stocks"] = """
SELECT CAST(timestamp AS VARCHAR) AS "Timestamp",
       CASE WHEN volume = 1 THEN NULL ELSE asset_name END AS "Name",
       '$' || CAST(CAST(floor(close * 100) AS BIGINT) AS VARCHAR) AS "Last",
       high AS "High", low AS "Low", close - open AS "Chg_",
       CAST(CAST(floor((close - open) * 100) AS BIGINT) AS VARCHAR) || '%' AS "Chg_%",
       CASE volume % 4 WHEN 0 THEN CAST(volume AS VARCHAR) || 'M' WHEN 1 THEN CAST(volume AS VARCHAR) || 'B'
            WHEN 2 THEN CAST(volume AS VARCHAR) || '%' ELSE 'n/a' END AS "Vol.",
       'x' AS "Notes"
FROM bars"""

VIEWS["raw_crypto"] = """
SELECT CAST(timestamp AS VARCHAR) AS "Timestamp", upper(asset_name) || '-USD' AS "Name",
       upper(asset_name) AS "Symbol",
       CASE WHEN volume = 2 THEN '--'
            ELSE '"' || CAST(CAST(floor(close * 100) AS BIGINT) AS VARCHAR) || '"' END AS "Price_USD",
       volume AS "Vol_24h", close - open AS "Chg_24h",
       CAST(CAST(floor(high * 100) AS BIGINT) AS VARCHAR) || 'M' AS "Market_Cap", 1 AS "Junk!"
FROM bars"""

VIEWS["stock_bars"] = """
SELECT asset_name, timestamp, open AS "Open", high AS "High", low AS "Low", close AS "Close",
       volume AS "Volume" FROM bars WHERE asset_name < 'p'"""

VIEWS["crypto_bars"] = """
SELECT upper(asset_name) || '-USD' AS asset_name, timestamp, open AS "Open", high AS "High", low AS "Low",
       close AS "Close", volume AS "Volume" FROM bars WHERE asset_name >= 'p'"""

VIEWS["stock_shaped"] = """
SELECT timestamp, asset_name AS name, "Close" AS last, "High" AS high, "Low" AS low,
       "Close" - "Open" AS chg_abs, ("Close" - "Open") / nullif("Open", 0) * 100 AS chg_pct,
       "Volume" AS vol
FROM stock_bars"""

VIEWS["crypto_shaped"] = f"""
SELECT timestamp, asset_name AS name, split_part(asset_name, '-', 1) AS symbol, "Close" AS price_usd,
       "Volume" AS vol_24h, "Volume" AS total_vol, ("Close" - "Open") / nullif("Open", 0) * 100 AS chg_24h,
       (CASE WHEN lag("Close", 7) OVER w = 0
             THEN (CASE WHEN "Close" > 0 THEN {dlit(float('inf'))} WHEN "Close" < 0 THEN {dlit(float('-inf'))} END)
             ELSE "Close" / lag("Close", 7) OVER w - 1 END) * 100 AS chg_7d,
       "Close" * {dlit(1e6)} AS market_cap
FROM crypto_bars WINDOW w AS (PARTITION BY asset_name ORDER BY timestamp)"""

DEPS.update({
    "raw_bars": ["bars"], "raw_stocks": ["bars"], "raw_crypto": ["bars"],
    "stock_bars": ["bars"], "crypto_bars": ["bars"],
    "stock_shaped": ["stock_bars"], "crypto_shaped": ["crypto_bars"],
})


def feature_ctes(cfg: FeatureConfig, feature_cols: list[str]) -> list[tuple[str, str]]:
    """CTEs ending in ``feat`` (the feature table, full precision, rows with nulls dropped)."""
    ctes, name = indicator_select(cfg)
    cond = " AND ".join(f'"{c}" IS NOT NULL' for c in feature_cols)
    ctes.append(("feat", f"SELECT * FROM {name} WHERE {cond}"))
    return ctes


def dq_union(dataset: str, source: str, present: list[tuple[str, bool]], required_missing: int,
             max_ratio: float, dup_keys: list[str]) -> str:
    """SQL rows of validate_dataset for one dataset (``present``: (column, is_numeric))."""
    parts, cid = [], 0
    aggs = ["count(*) AS n"]
    for i, (c, num) in enumerate(present):
        aggs.append(f'count(*) FILTER (WHERE "{c}" IS NULL) AS null_{i}')
        if num:
            aggs.append(f'count(*) FILTER (WHERE "{c}" < 0) AS neg_{i}')
            aggs.append(f'count("{c}") AS nn_{i}')
    stats = f"(SELECT {', '.join(aggs)} FROM {source})"

    def row(check: str, passed: str, observed: str, where: str = "") -> None:
        nonlocal cid
        cid += 1
        check_sql = check.replace("'", "''")
        parts.append(f"SELECT '{dataset}' AS dataset, {cid} AS check_id, '{check_sql}' AS check_name, "
                     f"({passed}) AS passed, CAST({observed} AS DOUBLE) AS observed FROM {stats} {where}")

    row("DataFrame not empty", "n > 0", "n")
    row("Required columns present", "true" if required_missing == 0 else "false", str(required_missing))
    for c, num in present:
        row(f"Column '{c}' is numeric", "true" if num else "false", "1.0" if num else "0.0")
    for i, (c, _) in enumerate(present):
        ratio = f"CAST(null_{i} AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0)"
        row(f"Null ratio for '{c}'", f"coalesce({ratio} <= {dlit(max_ratio)}, false)", ratio)
    if dup_keys:
        cid += 1
        label = "No duplicates on [" + ", ".join(f"''{k}''" for k in dup_keys) + "]"
        keys = ", ".join(f'"{k}"' for k in dup_keys)
        parts.append(
            f"SELECT '{dataset}', {cid}, '{label}', coalesce(sum(c - 1), 0) = 0, "
            f"CAST(coalesce(sum(c - 1), 0) AS DOUBLE) FROM (SELECT count(*) AS c FROM {source} GROUP BY {keys})")
    for i, (c, num) in enumerate(present):
        if num:
            row(f"Column '{c}' has no negative values", f"neg_{i} = 0", f"neg_{i}", f"WHERE nn_{i} > 0")
    return "\nUNION ALL\n".join(parts)
