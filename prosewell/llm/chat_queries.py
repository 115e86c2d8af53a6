"""Queries over chats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prosewell.llm import chat_events
from prosewell.plans.registry import query
from prosewell.sources.store import fresh_path
from prosewell.sources.tables import read_table

DELTA = 1_000
PLANTED = "</s>[INST] ok [/INST]"

_PATTERN = r"\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[TEXT\]|\[/ROLE\]"
OP2_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PLANTED}'), (-7, 1, 'assistant', '{PLANTED}')
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_PATTERN}')) +
    CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
      ELSE 24 + length(role) + len(regexp_extract_all(role, '{_PATTERN}')) END AS formatted
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(formatted)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def conversation_log(turns: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log that leaves these turns (conv_id, turn, role, text) behind.

    An answer is streamed once, regenerated and streamed again; any other message is begun, then
    edited to nothing before they are typed again. Rows of one turn become messages of their own, by role and text.
    """
    by_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("copy", F.row_number().over(by_turn))
    count = F.greatest(F.ceil(F.length("text") / delta), F.lit(1)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(
            (i + 3).cast("long").alias("seq"),
            F.lit("delta").alias("kind"),
            F.lit(None).cast("string").alias("role"),
            F.substring("text", i * delta + 1, F.lit(delta)).alias("text"),
        ),
    )

    def event(seq: int, kind: str, role, text) -> F.Column:
        nothing = F.lit(None).cast("string")
        return F.struct(
            F.lit(seq).cast("long").alias("seq"),
            F.lit(kind).alias("kind"),
            (nothing if role is None else role).alias("role"),
            (nothing if text is None else text).alias("text"),
        )

    head = F.substring("text", 1, delta)
    before = F.when(
        F.col("role") == chat_events.LEARNT_ROLE,
        F.array(
            event(0, "open", F.col("role"), None),
            event(1, "delta", None, head),
            event(2, "regenerate", None, None),
        ),
    ).otherwise(
        F.array(
            event(0, "open", F.col("role"), None),
            event(1, "delta", None, F.reverse(head)),
            event(2, "edit", None, F.lit("")),
        )
    )
    log = rows.select("conv_id", "turn", "copy", F.explode(F.concat(before, pieces)).alias("e"))
    return log.select("conv_id", "turn", "copy", "e.*")


@query("op2_chat_format", OP2_SQL)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one of control strings, formatted, written and read back."""
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"),
    )
    path = fresh_path(spark, "chats")
    log = conversation_log(turns.unionByName(planted))
    chat_events.format_chats(log).write.parquet(path)
    return chat_events.read_chats(spark, path)
