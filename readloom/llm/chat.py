"""Multi-party perspective rotation (operator 10), with DataFrame functions only.

For every participant of a dialogue the turns are rendered with that speaker as assistant,
the other speakers as named users and system turns as system; the loss mask covers exactly
the assistant's messages.

The unit is one turn seen by one participant, so a dialogue of any length stays spread over
many rows: ``rotate`` emits those rows with each message's place in the rendered dialogue.
``render`` joins the messages of one (dialogue, participant) in turn order.

What speakers write cannot forge a turn: in messages every ``<|`` gets a backslash (``<\\|``; one that
is there already gets one more, so it can be undone), and in names ``|`` is written ``\\p``, a line feed ``\\n``
and a backslash ``\\\\``.

Defined results: a null dialogue id is a dialogue of its own; a turn without role has speaker
``unknown``; null text is empty; turns that tie are ordered by role and text and repeated rows
stay; a dialogue with only system turns has no participant and no row; an empty table gives
no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def _plain_name(name):
    for mark, plain in (("\\", "\\\\"), ("|", "\\p"), ("\n", "\\n")):
        name = F.replace(name, F.lit(mark), F.lit(plain))
    return name


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn and participant: conv_id, perspective, turn, speaker, text, chat_role, name, message, trained."""
    said = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"<(\\*)\|", r"<\\$1|")
    turns = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.nullif(F.trim(F.col(role)), F.lit("")), F.lit("unknown")).alias("speaker"), said.alias("text"))
    people = turns.where("speaker <> 'system'").select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = turns.join(people, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == "system"
    chat_role = F.when(system, "system").when(own, "assistant").otherwise("user")
    name = F.when(chat_role == "user", F.col("speaker"))
    seen = seen.withColumns({"chat_role": chat_role, "name": name, "trained": own & ~system})
    head = F.concat(F.lit("<|"), F.col("chat_role"), F.coalesce(F.concat(F.lit(" name="), _plain_name(F.col("name"))), F.lit("")), F.lit("|>\n"))
    return seen.withColumns({"head": head, "message": F.concat(head, F.col("text"), F.lit("<|end|>\n"))})


def render(rotated: DataFrame) -> DataFrame:
    """One row per dialogue and participant: the rendered dialogue, its trained character spans and counts."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "speaker", "text", "head", "message", "trained")))
    out = rotated.groupBy("conv_id", "perspective").agg(ordered.alias("m"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).cast("long").alias("n"))

    def step(acc, m):
        begin = acc["at"] + F.length(m["head"])
        end = acc["at"] + F.length(m["message"])
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct((acc["at"] + F.length(m["message"])).alias("at"), F.when(m["trained"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"), (acc["n"] + F.when(m["trained"], end - begin).otherwise(0)).alias("n"))

    folded = F.aggregate("m", start, step)
    return out.withColumn("f", folded).select(
        "conv_id",
        "perspective",
        F.size("m").cast("long").alias("n_messages"),
        F.size(F.filter("m", lambda x: x["trained"])).cast("long").alias("n_trained"),
        F.array_join(F.transform("m", lambda x: x["message"]), "").alias("rendered"),
        F.array_join(F.transform("m", lambda x: F.when(x["trained"], "1").otherwise("0")), "").alias("message_mask"),
        F.array_join("f.spans", ",").alias("trained_spans"),
        F.col("f.n").alias("trained_chars"),
    )


def op10_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective."""
    return render(rotate(table(spark, sf_dir, "conversations")))


OP10_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') AS speaker, regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g') AS text FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'
), seen AS (
  SELECT t.*, p.perspective,
    '<|' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user name=' || replace(replace(replace(speaker, '\', '\\'), '|', '\p'), chr(10), '\n') END || '|>' || chr(10) AS head,
    speaker = perspective AS trained
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, head || text || '<|end|>' || chr(10) AS message,
    row_number() OVER w AS k,
    sum(length(head) + length(text) + 8) OVER w AS ends
  FROM seen
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn, speaker, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, perspective, count(*) AS n_messages, count(*) FILTER (trained) AS n_trained,
  string_agg(message, '' ORDER BY k) AS rendered,
  string_agg(CASE WHEN trained THEN '1' ELSE '0' END, '' ORDER BY k) AS message_mask,
  coalesce(string_agg(CAST(ends - length(text) - 8 AS VARCHAR) || '-' || CAST(ends AS VARCHAR), ',' ORDER BY k) FILTER (trained), '') AS trained_spans,
  CAST(coalesce(sum(length(text) + 8) FILTER (trained), 0) AS BIGINT) AS trained_chars
FROM placed GROUP BY conv_id, perspective
"""
