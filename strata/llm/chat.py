"""Chat formatting: every dialogue rendered once from each participant's point of view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
#: Turns of one rendered part: longer dialogues come in several parts.
PART_TURNS = 512


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, speaker, part, n_turns, n_trained, text, mask), one row per dialogue, participant and part.

    Participants are the distinct roles of a dialogue except ``system``. From
    the view of ``speaker`` their turns are the assistant's, others are users
    with their role as name, system turns stay system; ``mask`` lists the
    code point ranges ``start-end`` of ``text`` to train on: the speaker's
    words and the closing mark. Turns are in order of turn, role and text
    (nulls first); repeated rows are rendered each. A null text is empty, a
    null role is a nameless user and no participant, a null turn counts as
    turn 0 of part 0, and rows without a conv_id are one dialogue. A dialogue
    whose only roles are system or null gives no rows, as does an empty
    table. Other columns are ignored.

    Part p holds turns p * ``part_turns`` and on (by turn number, so no
    dialogue has to be sorted as a whole): a dialogue with a third of all
    turns is spread over its parts.
    """
    turns = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        # tells a null conv_id from every other, so that plain joins match it
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
    )
    part = F.floor(F.coalesce("turn", F.lit(0)) / part_turns).alias("part")
    people = turns.filter(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select("key", F.col("role").alias("speaker")).distinct()
    whole = turns.groupBy("key", "conv_id", part).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    seen = whole.join(people, "key")
    mine = lambda t: F.coalesce(t.role == F.col("speaker"), F.lit(False))
    head = lambda t: F.concat(
        F.lit(OPEN), F.when(mine(t), "assistant").when(t.role.isNull(), "user").when(t.role == SYSTEM, SYSTEM).otherwise(F.concat(F.lit("user name="), t.role)), F.lit("\n")
    )
    pieces = F.transform("turns", lambda t: F.struct(mine(t).alias("mine"), head(t).alias("head"), F.concat(t.text, F.lit(CLOSE)).alias("body")))
    seen = seen.withColumn("pieces", pieces)
    seen = seen.withColumn("sizes", F.transform("pieces", lambda p: F.length(p["head"]) + F.length(p["body"]) + 1))
    upto = F.transform(F.sequence(F.lit(0), F.size("sizes") - 1), lambda i: F.aggregate(F.slice("sizes", 1, i), F.lit(0).cast("long"), lambda a, x: a + x))
    placed = seen.withColumn("placed", F.zip_with("pieces", upto, lambda p, at: F.struct(p["mine"].alias("mine"), (at + F.length(p["head"])).alias("start"), (at + F.length(p["head"]) + F.length(p["body"])).alias("end"))))
    trained = F.filter("placed", lambda p: p["mine"])
    return placed.select(
        "conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), F.size(trained).cast("long").alias("n_trained"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.array_join(F.transform(trained, lambda p: F.concat_ws("-", p["start"].cast("string"), p["end"].cast("string"))), ",").alias("mask"),
    )


#: DuckDB: one row per turn and speaker, offsets from a running sum.
ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, floor(coalesce(turn, 0) / {PART_TURNS})::BIGINT AS part,
         row_number() OVER () AS id
  FROM conversations),
people AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> '{SYSTEM}'),
seen AS (
  SELECT t.*, speaker, coalesce(role = speaker, false) AS mine,
    '{OPEN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role IS NULL THEN 'user' WHEN role = '{SYSTEM}' THEN '{SYSTEM}' ELSE 'user name=' || role END || chr(10) AS head,
    text || '{CLOSE}' AS body
  FROM t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role NULLS FIRST, text, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM seen)
SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (mine) AS n_trained,
  string_agg(head || body || chr(10), '' ORDER BY before) AS text,
  coalesce(string_agg((before + length(head))::BIGINT || '-' || (before + length(head) + length(body))::BIGINT, ',' ORDER BY before) FILTER (mine), '') AS mask
FROM placed GROUP BY conv_id, speaker, part
"""
