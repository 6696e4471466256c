"""Sources over files that Spark writes from the documents: archives and CSV."""

from __future__ import annotations

import io
import zipfile
from itertools import groupby

import pyarrow as pa
from pyspark.sql import functions as F

from lintel.operators.resumable import resumable
from lintel.sources import files as S
from lintel.sources.ranges import write_bytes
from lintel.sources.records import csv_records
from lintel.storage import fresh_path, table, written


def _archives(spark, sf_dir):
    """(folder, table of archive and doc_id): fifty documents an archive, each a class ``Utils`` in a package of its own, in two versions."""
    folder = fresh_path(spark, "archives")
    docs = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 50).alias("part"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def write(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for part, mine in groupby(rows, key=lambda r: r[0]):
            out, keys = io.BytesIO(), []
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for _, key, text in mine:
                    keys.append(key)
                    z.writestr(zipfile.ZipInfo(f"r/Flaky/src/com/p{key % 7}/d{key}/Utils.java"), text, zipfile.ZIP_DEFLATED)
                    z.writestr(zipfile.ZipInfo(f"r/Fixed/src/com/p{key % 7}/d{key}/Utils.java"), text + "fixed", zipfile.ZIP_DEFLATED)
            write_bytes(f"{folder}/a{part}.zip", out.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(keys)), pa.array(keys)], ["part", "doc_id"])

    dealt = docs.repartition("part").sortWithinPartitions("part", "doc_id")
    return folder, written(dealt.mapInArrow(write, "part long, doc_id long"), "archives-keys")


def _archive_sources(spark, sf_dir):
    """A third of the classes, an inner one of each; nothing else of an archive is read."""
    folder, keys = _archives(spark, sf_dir)
    names = S.archives.listed(spark, folder, "*.zip").select(F.col("path").alias("archive"), F.regexp_extract("path", r"/a(\d+)\.zip$", 1).cast("long").alias("part"))
    wanted = keys.filter("doc_id % 3 = 0").join(names, "part").select("archive", "doc_id", F.lit("Flaky").alias("version"), F.format_string("com.p%d.d%d.Utils$In", F.col("doc_id") % 7, "doc_id").alias("class"))
    out = S.wanted_sources(spark, folder, wanted)
    return out.select("doc_id", "entry", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def _quoted_records(spark, sf_dir):
    """Whole texts in quotes, line breaks and all, among lines of few fields."""
    folder = fresh_path(spark, "quoted")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    quoted = F.concat(F.lit('"'), F.replace("t", F.lit('"'), F.lit('""')), F.lit('"'))
    lines = F.concat(F.col("doc_id").cast("string"), F.lit(","), quoted, F.lit(',5" disk'), F.when(F.col("doc_id") % 4 == 0, F.lit("\n,odd\n")).otherwise(""))
    docs.select(lines.alias("value")).write.text(folder)
    found = csv_records(spark, folder).filter("fields[0] != ''")
    return found.select(F.col("fields")[0].cast("long").alias("doc_id"), F.size("fields").cast("long").alias("n"), F.md5(F.col("fields")[1]).alias("md5"), F.col("fields")[2].alias("last"))


class Stopped(Exception):
    """What breaks a run off here."""


def _resumed(spark, sf_dir):
    """Line items summed by order, range by range: the first run breaks off at the third range, the second takes the rest."""
    path, calls = fresh_path(spark, "resumed"), []

    def stage(rows):
        calls.append(1)
        if len(calls) == 3:
            raise Stopped
        return rows.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))

    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    try:
        resumable(items, "l_orderkey", stage, path, 4)
    except Stopped:
        pass
    return resumable(items, "l_orderkey", stage, path, 4)


QUERIES = {"archive_sources": _archive_sources, "quoted_records": _quoted_records, "resumed_stage": _resumed}
SQL = {
    "archive_sources": "SELECT doc_id, 'r/Flaky/src/com/p' || doc_id % 7 || '/d' || doc_id || '/Utils.java' AS entry, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes, sha256(coalesce(text, '')) AS sha256 FROM documents WHERE doc_id % 3 = 0",
    "resumed_stage": "SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY l_orderkey",
    "quoted_records": "SELECT doc_id, CAST(3 AS BIGINT) AS n, md5(coalesce(text, '')) AS md5, '5\" disk' AS last FROM documents",
}
