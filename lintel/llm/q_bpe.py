"""op9: byte-level BPE ids of every document, and the bytes they decode to, as digests."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.byte_bpe import encode
from lintel.storage import table

RANKS = "byte_bpe_50k.tiktoken"


def digests(df: DataFrame) -> DataFrame:
    """Columns n_tokens, ids_sha256 and decoded_sha256 from columns ids and decoded."""
    return (
        df.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256))
        .withColumn("decoded_sha256", F.sha2("decoded", 256))
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode(docs, RANKS, public_tokenizers.PATTERN, back="decoded")
    return digests(out).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES = {"op9_byte_bpe": op9_byte_bpe}
SQL: dict[str, str] = {}
