"""Chat formatting: a conversation seen by each of its speakers in turn.

For every participant the dialogue is rendered with that speaker as ``assistant`` and all
others as named users. The mask lists the spans, in characters of the rendered text,
that are trained on: what the speaker says, with the end mark, without the header.

A conversation is rendered in parts of ``PART_TURNS`` turn numbers, so one that holds a large
share of all rows is many bounded groups, and no list of a whole conversation is ever
built; texts of the parts of one conversation and speaker, in order, make up the whole.
All of it is DataFrame functions: one aggregation of messages by part, one join with the
distinct speakers.

Defined results: conversation id null: the rows belong to no conversation and are not
rendered. Speaker null or blank: named ``unknown``. Text null or empty: an empty message. Turn
null: behind all numbered turns, in a part of its own (part null). Equal turn numbers: in the
order of speaker and text; repeated rows are rendered as often as they occur.
Narrators (``system``) are part of every view and have none of their own, so a conversation of
narrators alone gives no rows. Marks of the format inside a text are broken up by a space.
Names keep letters, digits, ``_`` and ``-``; other characters become ``_``. An empty table
gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, table

PART_TURNS = 512
NARRATORS = ("system",)
UNKNOWN = "unknown"
START, END = "<|im_start|>", "<|im_end|>\n"


def perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    narrators: tuple[str, ...] = NARRATORS,
) -> DataFrame:
    """Per conversation, speaker and part: n_turns, rendered, mask (array of start and end)."""
    name = F.regexp_replace(F.trim(F.col(speaker).cast("string")), r"[^\p{L}\p{N}_-]", "_")
    messages = turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("conversation"),
        F.floor(F.col(turn) / PART_TURNS).alias("part"),
        F.struct(
            F.col(turn).isNull().alias("late"),
            F.col(turn).alias("turn"),
            F.when(F.length(name) > 0, name).otherwise(F.lit(UNKNOWN)).alias("name"),
            F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"<\|(im_start|im_end)", r"<| $1").alias("body"),
        ).alias("message"),
    )
    parts = messages.groupBy("conversation", "part").agg(F.sort_array(F.collect_list("message")).alias("messages"))
    speakers = (
        messages.select("conversation", F.col("message.name").alias("speaker")).where(~F.col("speaker").isin(*narrators)).distinct()
    )

    def segment(m):
        head = (
            F.when(m["name"] == F.col("speaker"), F.lit(f"{START}assistant\n"))
            .when(m["name"].isin(*narrators), F.concat(F.lit(START), m["name"], F.lit("\n")))
            .otherwise(F.concat(F.lit(f"{START}user name="), m["name"], F.lit("\n")))
        )
        return F.struct(head.alias("head"), F.concat(m["body"], F.lit(END)).alias("said"), (m["name"] == F.col("speaker")).alias("own"))

    def behind(so_far, s):
        start = so_far["at"] + F.char_length(s["head"])
        end = start + F.char_length(s["said"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(s["own"], F.concat(so_far["spans"], span)).otherwise(so_far["spans"]).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    seen = parts.join(speakers, "conversation").select(
        "conversation", "speaker", "part", F.transform("messages", segment).alias("segments")
    )
    return seen.select(
        F.col("conversation").alias(conversation),
        "speaker",
        "part",
        F.size("segments").cast("long").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["said"])), "").alias("rendered"),
        F.aggregate("segments", nothing, behind, lambda done: done["spans"]).alias("mask"),
    )


SQL = r"""
WITH named AS (
  SELECT conv_id, turn, turn IS NULL AS late, regexp_replace(trim(role), '[^\p{L}\p{N}_-]', '_', 'g') AS name,
    regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)', '<| \1', 'g') AS body
  FROM conversations WHERE conv_id IS NOT NULL
), messages AS (
  SELECT conv_id, turn, late, body, CAST(floor(turn / 512) AS BIGINT) AS part,
    CASE WHEN length(name) > 0 THEN name ELSE 'unknown' END AS name
  FROM named
), speakers AS (
  SELECT DISTINCT conv_id, name AS speaker FROM messages WHERE name <> 'system'
), seen AS (
  SELECT m.conv_id, speaker, part, turn, late, name, body, name = speaker AS own,
    CASE WHEN name = speaker THEN '<|im_start|>assistant' || chr(10)
         WHEN name = 'system' THEN '<|im_start|>system' || chr(10)
         ELSE '<|im_start|>user name=' || name || chr(10) END AS head,
    body || '<|im_end|>' || chr(10) AS said
  FROM messages m JOIN speakers s ON m.conv_id = s.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(said)) OVER (
    PARTITION BY conv_id, speaker, part ORDER BY late, turn, name, body ROWS UNBOUNDED PRECEDING) AS behind
  FROM seen
)
SELECT conv_id, speaker, part, count(*) AS n_turns,
  string_agg(head || said, '' ORDER BY late, turn, name, body) AS rendered,
  coalesce(string_agg(CASE WHEN own THEN CAST(behind - length(said) AS BIGINT) || ':' || CAST(behind AS BIGINT) END, ',' ORDER BY behind), '') AS mask
FROM placed GROUP BY conv_id, speaker, part
"""


@query("op1_chat_perspectives", SQL)
def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return perspectives(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(spans, ","))
