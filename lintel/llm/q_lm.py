"""op1: language model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.lm import learn, score
from lintel.llm.q_quality import held_out
from lintel.storage import table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = learn(docs.filter(~held_out(F.col("doc_id"), 10)))
    out = score(docs, learned)
    return out.select(
        "doc_id",
        held_out(F.col("doc_id"), 10).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(learned.n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


QUERIES = {"op1_lm_scoring": op1_lm_scoring}
SQL: dict[str, str] = {}
