"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with that participant as the assistant and all
others as named users; the mask covers what the assistant says (text and end marker), as spans of characters.

A rendering is one row while the conversation is short. Its messages are dealt into parts of ``TURNS`` turns, and a part of over
``CROWD`` messages further into turns and ranges of a message hash, so no row gathers an unbounded number of messages,
and the parts of a rendering, in order of ``part_turn`` and ``part_range``, follow each other without loss.

Defined results: messages come in order of turn (null first), then of a hash of role and text; a null role speaks as
``unknown``; a null text is empty; repeated messages are all kept; rows without a conversation id form one
conversation; a marker inside a text is broken by a space; an empty table renders nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Turns of a part, messages from which a part is dealt out further.
TURNS, CROWD = 256, 2048
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def messages(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, body, mark, part_turn, part_range`` of every message."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    plain = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        safe(F.coalesce(F.col(role), F.lit("unknown"))).alias("role"),
        safe(F.coalesce(F.col(text), F.lit(""))).alias("body"),
    )
    marked = plain.withColumn("mark", F.md5(F.concat_ws("|", "role", "body")))
    start = F.coalesce(F.floor(F.col("turn") / TURNS) * TURNS, F.lit(-1)).cast("long")
    parted = marked.withColumn("start", start)
    crowded = parted.groupBy("conv", "start").count().where(F.col("count") > CROWD).select(F.col("conv").alias("c"), F.col("start").alias("s"), F.lit(True).alias("crowded"))
    joined = parted.join(crowded, F.col("conv").eqNullSafe(F.col("c")) & (F.col("start") == F.col("s")), "left")
    deep = F.coalesce("crowded", F.lit(False))
    return joined.select(
        "conv", "turn", "role", "body", "mark",
        F.when(deep, F.coalesce("turn", F.lit(-1))).otherwise(F.col("start")).alias("part_turn"),
        F.when(deep, F.substring("mark", 1, 3)).otherwise(F.lit("")).alias("part_range"),
    )


def _segment(m: Column, speaker: Column) -> Column:
    """Head and body of a message as the speaker's own or another's."""
    own = m["role"] == speaker
    return F.concat(F.when(own, F.lit(f"{OPEN}assistant\n")).otherwise(F.concat(F.lit(f"{OPEN}user name="), m["role"], F.lit("\n"))), m["body"], F.lit(CLOSE))


def rotate(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation, part and participant.

    Columns: ``conversation``, perspective, part_turn, part_range, n_messages, n_own, rendered, mask (array of struct
    ``start, end``, in characters of ``rendered``).
    """
    said = messages(rows, conversation, turn, role, text)
    parts = said.groupBy("conv", "part_turn", "part_range").agg(F.array_sort(F.collect_list(F.struct("turn", "mark", "role", "body"))).alias("m"))
    people = said.select(F.col("conv").alias("c"), F.col("role").alias("perspective")).distinct()
    views = parts.join(people, F.col("conv").eqNullSafe(F.col("c")))
    seen = F.transform("m", lambda m: F.struct((m["role"] == F.col("perspective")).alias("own"), _segment(m, F.col("perspective")).alias("s"), F.length(m["body"]).alias("n")))
    views = views.withColumn("seen", seen)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    head = len(f"{OPEN}assistant\n")

    def step(state: Column, s: Column) -> Column:
        end = state["at"] + F.length(s["s"])
        span = F.struct((state["at"] + head).alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(s["own"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return views.select(
        F.col("conv").alias(conversation),
        "perspective",
        "part_turn",
        "part_range",
        F.size("m").cast("long").alias("n_messages"),
        F.size(F.filter("seen", lambda s: s["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("seen", lambda s: s["s"]), "").alias("rendered"),
        F.aggregate("seen", start, step, lambda s: s["spans"]).alias("mask"),
    )


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ";")
    return views.withColumn("mask", spans)


OP10_SQL = rf"""
WITH p AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
q AS (SELECT *, md5(role || '|' || body) AS mark, CAST(coalesce(floor(turn / {TURNS}.0) * {TURNS}, -1) AS BIGINT) AS start FROM p),
r AS (SELECT *, count(*) OVER (PARTITION BY conv_id, start) > {CROWD} AS crowded FROM q),
m AS (
  SELECT conv_id, turn, role, body, mark, CASE WHEN crowded THEN coalesce(turn, -1) ELSE start END AS part_turn,
         CASE WHEN crowded THEN mark[1:3] ELSE '' END AS part_range
  FROM r),
v AS (
  SELECT m.*, w.perspective, m.role = w.perspective AS own,
         CASE WHEN m.role = w.perspective THEN '{OPEN}assistant' || chr(10) ELSE '{OPEN}user name=' || m.role || chr(10) END AS head
  FROM m JOIN (SELECT DISTINCT conv_id, role AS perspective FROM p) w ON m.conv_id IS NOT DISTINCT FROM w.conv_id),
s AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS seg FROM v),
o AS (
  SELECT *, sum(length(seg)) OVER (PARTITION BY conv_id, perspective, part_turn, part_range ORDER BY turn NULLS FIRST, mark ROWS UNBOUNDED PRECEDING) AS upto FROM s)
SELECT conv_id, perspective, part_turn, part_range, count(*) AS n_messages, count(*) FILTER (own) AS n_own,
       string_agg(seg, '' ORDER BY turn NULLS FIRST, mark) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(CAST(upto - length(seg) + length(head) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(upto AS BIGINT) AS VARCHAR) END, ';' ORDER BY turn NULLS FIRST, mark), '') AS mask
FROM o GROUP BY conv_id, perspective, part_turn, part_range
"""
