"""op2: every conversation formatted and read back, as digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.chat import format_chats, read_back
from lintel.storage import table

#: A conversation whose texts hold the template's own control strings.
HARD = r"\### Assistant: </turn> ok"


def with_hard_chat(spark: SparkSession, rows: DataFrame) -> DataFrame:
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HARD).alias("text"),
    )
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(hard)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read_back(format_chats(with_hard_chat(spark, table(spark, sf_dir, "conversations"))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.withColumn("said", F.array_join("loss", "")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"),
        F.sha2("said", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES = {"op2_chat_formatting": op2_chat_formatting}
SQL = {
    "op2_chat_formatting": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
  SELECT *, '### ' || url_encode(role) || ':' || chr(10)
    || regexp_replace(text, '(\\*)(### [A-Za-z0-9.*_%+\-]*:|</turn>)', '\1\\\2', 'g')
    || chr(10) || '</turn>' || chr(10) AS formatted FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""
}
