"""op3: every text as 8-bit samples in archives, read back, with features."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from lintel.llm.media import features, store, stored, wav_samples
from lintel.storage import fresh_path, table

UNIT = 192
LONG, TEXT = LongType(), StringType()
DIGESTS = StructType().add("payload_bytes", LONG).add("payload_sha256", TEXT).add("tail_crc32", LONG).add("media_bytes", LONG).add("media_sha256", TEXT).add("feature", TEXT)


@F.arrow_udf(DIGESTS)
def digests(media: pa.Array) -> pa.Array:
    rows = []
    for m in media:
        m = m.as_py()
        if m is None:
            rows.append(None)
            continue
        s = wav_samples(m)
        sha = hashlib.sha256
        rows.append({"payload_bytes": len(s), "payload_sha256": sha(s).hexdigest(), "tail_crc32": zlib.crc32(s[-16:]), "media_bytes": len(m), "media_sha256": sha(m).hexdigest(), "feature": features(s)})
    kinds = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    return pa.array(rows, pa.struct(kinds))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("payload"))
    folder = fresh_path(spark, "media")
    store(docs, f"{folder}/archives", unit=UNIT).write.parquet(f"{folder}/directory")
    members = stored(spark, f"{folder}/archives", f"{folder}/directory")
    return members.withColumn("d", digests("media")).select(F.col("key").alias("doc_id"), "n_bytes", "d.*", F.col("error").alias("read_error"))


QUERIES = {"op3_media_columns": op3_media_columns}
SQL: dict[str, str] = {}
