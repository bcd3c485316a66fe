"""One registered query per operator, over its whole intended table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import chat_format, decontaminate, host_quality, language, license_scan, mixing, near_dedup, periodic_runs, sharding, substring_dedup, token_blocks, toxicity, whitening
from barline.llm.text import prepare, scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    control = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(control).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    made = chat_format.format_events(chat_format.events_of_turns(turns))
    back = made.select("conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                       chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE["op1_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, md5(text) AS digest,
    regexp_replace(regexp_replace(replace(text, '&', '&amp;'), '\[(/?INST\])', '&#91;\1', 'g'), '<(/?s>)', '&lt;\1', 'g') AS body,
    replace(regexp_replace(regexp_replace(replace(role, '&', '&amp;'), '\[(/?INST\])', '&#91;\1', 'g'), '<(/?s>)', '&lt;\1', 'g'),
            chr(10), '&#10;') AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, digest)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, digest)) AS loss_sha256,
  CAST(sum(length(body) + CASE WHEN role = 'assistant' THEN 7 ELSE length(shown) + 14 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (toxicity.remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query
def op3_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality.host_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *host_quality.STATS, "base_failed", "kept")


ORACLE["op3_host_quality"] = r"""
WITH w AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         row_number() OVER () AS rid FROM documents),
lines AS (
  SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line),
dup AS (SELECT rid, sum(n - 1) AS n_dup_lines FROM lines GROUP BY rid),
wins AS (
  SELECT rid, i, array_to_string(words[i:i+7], ' ') AS key
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 8)) AS p
        FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, key) AS c FROM wins) WHERE c > 1) GROUP BY rid),
stats AS (
  SELECT w.rid, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN dup ON w.rid = dup.rid LEFT JOIN rep ON w.rid = rep.rid),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats),
hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT)::DOUBLE AS f FROM judged GROUP BY source),
prior AS (
  SELECT avg(f / n) AS m, coalesce(var_pop(f / n), 0) AS v FROM hosts),
weight AS (SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 100.0 END AS k FROM prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (h.f + weight.m * weight.k) / (h.n + weight.k) < 0.5 AS kept
FROM judged JOIN hosts h ON judged.source IS NOT DISTINCT FROM h.source, weight
"""


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = decontaminate.decontaminate(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return told.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE["op4_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i+9], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT rid, i, k, array_to_string(w[i:i+k-1], ' ') AS key
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
occ AS (SELECT rid, i, k, item_id FROM dw JOIN bw USING (k, key)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM occ) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item_id FROM occ) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.rid = hit.rid LEFT JOIN items ON d.rid = items.rid
"""


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(prepare(spark), sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op5_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '-' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source),
w AS (
  SELECT source, n, 2.0::DOUBLE * n AS cap,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight FROM s),
-- the level of every candidate set: all sources up to a ratio capped, the rest sharing what is left
levels AS (
  SELECT a.source, a.cap, a.weight,
         (SELECT 1.5::DOUBLE * sum(n) FROM s) - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight), 0) AS rest,
         sum(b.weight) FILTER (b.cap / b.weight >= a.cap / a.weight) AS open_weight
  FROM w a, w b GROUP BY a.source, a.cap, a.weight),
water AS (SELECT min(rest / open_weight) FILTER (rest / open_weight * weight < cap) AS dummy,
                 arg_min(rest / open_weight, cap / weight) FILTER (rest / open_weight * weight < cap) AS level FROM levels),
g AS (SELECT w.source, w.n, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM w, water),
c AS (
  SELECT d.doc_id, d.size, g.n AS source_size, g.target, CAST(round(g.target) AS BIGINT) AS goal,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE goal // source_size * size
            + least(greatest(goal % source_size - before, 0), size) END AS BIGINT) AS taken
FROM c
"""


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(prepare(spark), sf_dir, "documents"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    told = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return told.select("doc_id", (toxicity.remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch_path(spark, "token_blocks")
    token_blocks.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_blocks.read_tokens(spark, path)


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = substring_dedup.remove_repeats(table(prepare(spark), sf_dir, "documents"))
    return told.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op9_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT rid, doc_id, i, md5(array_to_string(w[i:i+49], ' ')) AS key
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
first AS (SELECT key, min(doc_id) AS first FROM win GROUP BY key),
gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (key) WHERE first < doc_id),
pos AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM pos WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.rid = pos.rid AND gone.p = pos.p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.rid = kept.rid
"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", sharding.lookup_table(spark)).select("doc_id", "slot", "shard")


ORACLE["op10_sharding"] = r"""
WITH RECURSIVE prefs AS (
  SELECT list(('0x' || substr(md5('shard-' || i), 1, 15))::BIGINT % 6553 ORDER BY i) AS offs,
         list(('0x' || substr(md5('shard-' || i), 17, 15))::BIGINT % 6552 + 1 ORDER BY i) AS skips
  FROM range(64) r(i)),
fill(t, shard, slot, taken, nxt) AS (
  SELECT 0, -1, -1, bitstring('0', 6553), list_transform(range(64), lambda x: 0::BIGINT)
  UNION ALL
  SELECT t + 1, shard, slot, set_bit(taken, slot, 1), nxt[1:shard] || [j + 1] || nxt[shard + 2:]
  FROM (
    SELECT *, CAST((off + j * skip) % 6553 AS INTEGER) AS slot
    FROM (
      SELECT *, coalesce(
        list_filter(range(low, least(low + 150, 6553)), lambda x: get_bit(taken, CAST((off + x * skip) % 6553 AS INTEGER)) = 0)[1],
        list_filter(range(low, 6553), lambda x: get_bit(taken, CAST((off + x * skip) % 6553 AS INTEGER)) = 0)[1]) AS j
      FROM (SELECT t, t % 64 AS shard, taken, nxt, nxt[t % 64 + 1] AS low, offs[t % 64 + 1] AS off, skips[t % 64 + 1] AS skip
            FROM fill, prefs WHERE t < 6553))))
SELECT doc_id, CAST(l.slot AS INTEGER) AS slot, CAST(l.shard AS INTEGER) AS shard
FROM documents JOIN fill l
  ON ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % 6553 = l.slot
"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(prepare(spark), sf_dir, "embeddings"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.repeat_tails(table(prepare(spark), sf_dir, "documents"))
    told = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(prepare(spark), sf_dir, "documents"))


def _license_templates() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({k}, {quoted(t.label)}, {str(t.exact).lower()}, {quoted(t.text)})" for k, t in enumerate(license_scan.TEMPLATES))


ORACLE["op13_license_scan"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (
  SELECT *, least(len(w), 4) AS k FROM (
    SELECT template, label, exact, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (VALUES {_license_templates()}) v(template, label, exact, text))),
g AS (
  SELECT template, label, exact, len(w) AS n, k, pos, array_to_string(w[pos+1:pos+k], ' ') AS key
  FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS pos FROM t)),
dg AS (
  SELECT rid, i, k, array_to_string(w[i+1:i+k], ' ') AS key
  FROM (SELECT rid, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
hits AS (SELECT rid, i, template, label, exact, n, g.k, pos FROM dg JOIN g ON dg.k = g.k AND dg.key = g.key),
places AS (
  SELECT rid, label, i - pos AS start FROM hits WHERE exact
  GROUP BY rid, template, label, n, k, i - pos HAVING count(*) = n - k + 1),
base AS (
  SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY rid),
steps AS (
  SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY rid, template ORDER BY diag, i) <= 4 THEN 0 ELSE 1 END AS fresh
  FROM (SELECT *, i - pos AS diag FROM hits WHERE NOT exact)),
banded AS (
  SELECT *, sum(fresh) OVER (PARTITION BY rid, template ORDER BY diag, i) AS band FROM steps),
bands AS (
  SELECT rid, template, label, n, band, max(i + k) - min(i) AS span FROM banded GROUP BY ALL),
cover AS (
  SELECT rid, template, band, count(DISTINCT word) AS c
  FROM (SELECT rid, template, band, unnest(range(pos, pos + k)) AS word FROM banded) GROUP BY ALL),
judged AS (
  SELECT rid, label, c / n::DOUBLE AS score, span <= 2 * n AND 10 * c >= 7 * n AS holds FROM bands JOIN cover USING (rid, template, band)),
told AS (
  SELECT rid, max(score) AS score, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (keep) AS labels
  FROM (SELECT rid, label, score, holds AS keep FROM judged UNION ALL SELECT rid, label, 1.0, true FROM places) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN base ON d.rid = base.rid LEFT JOIN told ON d.rid = told.rid
"""
