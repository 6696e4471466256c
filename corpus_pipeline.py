"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage but the last returns the columns of documents.  A stage sees all
rows that the one before it kept:

1. quality: documents that score below 0.3 go;
2. lines: lines that repeat an earlier one go, and documents left without any;
3. near_duplicates: of each component one row stays, that with the smallest id;
4. decontamination: contaminated documents go;
5. encoding: token ids of what is left, with digests of ids and decoded bytes.

Defined results of every stage: null and empty texts are scored, have no lines,
no shingles and no words, and stay; all columns of documents come back as they
were, whatever their names, but for ``text`` (lines) and ``n_chars`` where there
is one; equal rows share their fate, except that near_duplicates keeps one of
each component; rows without an id take part; an empty table stays empty.  The
last stage adds n_tokens, ids, ids_sha256 and decoded_sha256 and takes these
names for itself.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lintel.llm.byte_bpe import encode
from lintel.llm.decontaminate import decontaminate
from lintel.llm.jaccard import near_duplicates
from lintel.llm.lines import dedup_lines
from lintel.llm.q_bpe import RANKS, digests
from lintel.llm.q_quality import LEAST_SCORE, held_out
from lintel.llm.quality import learned, scored
from lintel.llm.words import row_id, set_aside
from lintel.storage import fresh_path, scratch, table, written


def _with(docs: DataFrame, key: str = "doc_id", text: str = "text"):
    """``docs`` with its id, text and n_chars, all other columns under names that no operator uses; and what names them again."""
    inner, back = set_aside(docs, key, text)
    named = dict(zip(docs.columns, inner.columns))
    names = {"key": key, "text": text} | ({named["n_chars"]: "n_chars"} if "n_chars" in named else {})
    undo = {theirs: mine for mine, theirs in names.items()}
    return inner.withColumnsRenamed(names), lambda out: back(out.withColumnsRenamed(undo))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"), 5))
    docs, back = _with(docs)
    return back(scored(docs, learned(docs, labels)).filter(F.col("score") >= LEAST_SCORE))


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, back = _with(docs)
    return back(_recounted(dedup_lines(docs).filter("kept > 0 or n_lines = 0")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one row stays: the smallest id, rows without an id last, then the lowest hash of id and text."""
    docs, back = _with(docs)
    rows = written(docs.withColumn("row", F.monotonically_increasing_id()), "near-rows")
    ids = rows.select("row", "doc_id", row_id(F.col("doc_id"), F.col("text")).alias("h"))
    found = near_duplicates(rows, "row").select("row", "component_id").join(ids, "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "row"))
    kept = found.groupBy("component_id").agg(first.alias("first")).select("first.row")
    return back(rows.join(kept, "row", "left_semi"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, back = _with(docs)
    return back(decontaminate(docs, table(spark, sf_dir, "benchmark")).filter(~F.col("contaminated")))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = encode(docs, RANKS, public_tokenizers.PATTERN, back="decoded")
    return digests(out).drop("decoded")


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_copies),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The quality classifier can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage writes on its way is removed when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with scratch(spark):
            docs = stage(spark, docs, sf_dir)
            docs.write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return docs
