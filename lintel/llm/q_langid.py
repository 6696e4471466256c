"""op10: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.langid import learned, predicted
from lintel.llm.q_quality import held_out
from lintel.storage import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learned(docs.filter(~held_out(F.col("doc_id"), 5)), VOCABULARY)
    out = predicted(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"), "lang_pred", "score")


QUERIES = {"op10_language_id": op10_language_id}
SQL: dict[str, str] = {}
