"""Chat formatting from an event log (operator 1).

An event is (conv_id, message, seq, kind, role, text): ``delta`` adds text to a
message, ``edit`` replaces its text, ``regenerate`` empties it and drops later
messages written before.  The log is folded per message (a hot conversation is
spread over its messages), messages are rendered, and a conversation is joined
from its rendered messages; only this last value is one row per conversation,
as the result asks for.

Template: an assistant message is ``<s>text</s>``, any other
``[INST]role`` newline ``text[/INST]``.  Inside texts and roles the four
control strings lose their first character to an entity (``&#91;`` or ``&lt;``)
and ``&`` becomes ``&amp;``, which reading back reverses.  The loss mask covers
assistant texts as (start, length) spans in code points of the formatted text.

Null texts and roles are empty.  A null conv_id is one conversation, null turns
come first.  Equal seq values are ordered by kind and text; repeated rows of a
turn are separate messages.  An empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = 256  # code points of one streamed delta
TURN = r"(?s)\[INST\]([^\n]*)\n(.*?)\[/INST\]|<s>(.*?)</s>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.regexp_replace(F.regexp_replace(text, r"\[(/?INST\])", "&#91;$1"), "<(/?s>)", "&lt;$1")


def unescape(text: Column) -> Column:
    for entity, char in (("&#10;", "\n"), ("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The event log that streams each row of (conv_id, turn, role, text) as deltas of ``PIECE`` code points.

    Rows of one conversation and turn are told apart by role, text and copy number.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    parts = F.when(F.length("text") > 0, F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % PIECE), F.lit(0))).otherwise(
        F.array(F.lit("")))
    message = F.struct("turn", "role", F.md5("text").alias("digest"), "copy")
    return rows.select("conv_id", message.alias("message"), "role", F.posexplode(parts).alias("seq", "text")).select(
        "conv_id", "message", F.col("seq").cast("long").alias("seq"), F.lit("delta").alias("kind"), "role", "text")


def fold_messages(events: DataFrame) -> DataFrame:
    """Final text of every message: what follows its last edit or regeneration, in sequence order."""
    entry = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    got = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(entry)).alias("log"), F.max("seq").alias("last_seq"),
        F.max_by("role", F.struct("seq", "kind")).alias("role"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"))
    reset = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i).otherwise(F.lit(0))))
    kept = F.slice("log", reset + 1, F.size("log"))
    text = F.array_join(F.transform(kept, lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"])), "")
    return got.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
                      "last_seq", "regenerated")


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: formatted text, loss spans and number of messages."""
    spoken = F.col("role") == "assistant"
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;"))
    body = messages.withColumn("body", escape(F.col("text"))).withColumn("spoken", spoken).withColumn(
        "shown", F.when(spoken, F.concat(F.lit("<s>"), F.col("body"), F.lit("</s>"))).otherwise(
            F.concat(F.lit("[INST]"), role, F.lit("\n"), F.col("body"), F.lit("[/INST]")))).drop("text", "role")
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    alive = body.withColumn("dropped", F.coalesce(F.max("regenerated").over(earlier) > F.col("last_seq"), F.lit(False)))
    alive = alive.where(~F.col("dropped"))
    alive = alive.withColumn("start", F.coalesce(F.sum(F.length("shown")).over(earlier), F.lit(0)))
    row = F.struct("message", "shown", "spoken", (F.col("start") + 3).alias("start"), F.length("body").alias("length"))
    rows = alive.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    spans = F.transform(F.filter("rows", lambda r: r["spoken"]), lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length")))
    return rows.select("conv_id", F.array_join(F.col("rows")["shown"], "").alias("formatted"), spans.alias("loss_spans"),
                       F.size("rows").cast("long").alias("n_messages"))


def format_events(events: DataFrame) -> DataFrame:
    """Reconstruct the messages of an event log and render every conversation."""
    return render(fold_messages(events))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), control strings restored."""
    whole, role, other, said = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in range(4))
    turns = F.arrays_zip(whole.alias("whole"), role.alias("role"), other.alias("other"), said.alias("said"))
    return F.transform(turns, lambda t: F.when(
        t["whole"].startswith("<s>"), F.struct(F.lit("assistant").alias("role"), unescape(t["said"]).alias("text"))).otherwise(
        F.struct(unescape(t["role"]).alias("role"), unescape(t["other"]).alias("text"))))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"]))), "")
