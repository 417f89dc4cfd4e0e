"""Multi-party perspective rotation, in DataFrame functions only.

Every participant of a conversation in turn is the assistant: the dialogue is
rendered with that speaker's turns as the assistant's, the others' as named
users', and the character spans of the assistant's texts are the ones a loss
may count. System turns are context and no participant of their own.

A conversation is rendered in chunks of ``chunk_turns`` turns, one row each per
participant, in the order of ``chunk``; all but very long conversations are one
chunk. Turns are numbered by a range sort over all conversations, so no task
holds a whole conversation however long it is.

Defined cases: a null role is the speaker "unknown", roles are trimmed and
lower-cased; a null text is empty; control marks within a text are defused;
a null ``conv_id`` is a conversation of its own; null turns come first, equal
turns are ordered by role and text, repeated rows are rendered each; a
conversation of system turns alone has no participant and gives no row; an
empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import staged
from martlet.operators.windows import global_row_number

SYSTEM = "system"
ASSISTANT_OPEN, SYSTEM_OPEN, CLOSE = "<|assistant|>\n", "<|system|>\n", "<|end|>\n"
CHUNK_TURNS = 256


def user_open(name: Column) -> Column:
    return F.concat(F.lit("<|user name="), name, F.lit("|>\n"))


def numbered_turns(turns: DataFrame, chunk_turns: int) -> DataFrame:
    """conv_id, role, text, at (0.. within the conversation), chunk."""
    role = F.lower(F.trim(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))))
    text = F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.replace(F.when(role == "", F.lit("unknown")).otherwise(role), F.lit("|>"), F.lit("| >")).alias("role"),
        text.alias("text"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = global_row_number(rows, order, "number")
    first = rows.groupBy(F.col("conv_id").alias("c")).agg(F.min("number").alias("first"))
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")))
    at = F.col("number") - F.col("first")
    return rows.select("conv_id", "role", "text", at.alias("at"), F.floor(at / chunk_turns).alias("chunk"))


def rotate(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """conv_id, speaker, chunk, turns, text and loss_spans (array of start,
    end: code points within ``text``, end exclusive)."""
    rows = staged(numbered_turns(turns, chunk_turns), "chat-turns")
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    chunks = rows.groupBy("conv_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("held")
    )
    pairs = chunks.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))

    def head(t: Column) -> Column:
        return (
            F.when(t["role"] == SYSTEM, F.lit(SYSTEM_OPEN))
            .when(t["role"] == F.col("speaker"), F.lit(ASSISTANT_OPEN))
            .otherwise(user_open(t["role"]))
        )

    def advance(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(head(t))
        end = start + F.length(t["text"])
        # the closing mark of the assistant's turn is learnt too
        stop = end + len(CLOSE)
        own = t["role"] == F.col("speaker")
        return F.struct(
            stop.cast("long").alias("at"),
            F.when(
                own,
                F.concat(
                    state["spans"],
                    F.array(F.struct(start.cast("long").alias("start"), stop.cast("long").alias("end"))),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        )

    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )
    text = F.array_join(F.transform("held", lambda t: F.concat(head(t), t["text"], F.lit(CLOSE))), "")
    return pairs.select(
        "conv_id",
        "speaker",
        "chunk",
        F.size("held").cast("long").alias("turns"),
        text.alias("text"),
        F.aggregate("held", start, advance, lambda s: s["spans"]).alias("loss_spans"),
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")


#: What ``rotate`` gives, for conversations of any length, with spans as text.
ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE lower(trim(role)) END AS r,
         replace(coalesce(text, ''), '<|', '< |') AS x, turn
  FROM conversations
), n AS (
  SELECT conv_id, replace(r, '|>', '| >') AS role, x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) - 1 AS place
  FROM t
), c AS (SELECT *, CAST(floor(place / {CHUNK_TURNS}.0) AS BIGINT) AS chunk FROM n),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM n WHERE role <> '{SYSTEM}'),
h AS (
  SELECT c.conv_id, s.speaker, c.chunk, c.place, c.role, c.x,
         CASE WHEN c.role = '{SYSTEM}' THEN '<|system|>' WHEN c.role = s.speaker THEN '<|assistant|>'
              ELSE '<|user name=' || c.role || '|>' END || chr(10) AS head
  FROM c JOIN s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
), o AS (
  SELECT *, sum(length(head) + length(x) + {len(CLOSE)}) OVER
           (PARTITION BY conv_id, speaker, chunk ORDER BY place ROWS UNBOUNDED PRECEDING) AS stop
  FROM h
)
SELECT conv_id, speaker, CAST(chunk AS BIGINT) AS chunk, count(*) AS turns,
       string_agg(head || x || '<|end|>' || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CASE WHEN role = speaker THEN
         CAST(CAST(stop - {len(CLOSE)} - length(x) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR) END, ',' ORDER BY place), '')
         AS loss_spans
FROM o GROUP BY conv_id, speaker, chunk
"""
