"""Source divergence audit by two-dimensional tiling of groups.

A group is a source of a language; its terms are runs of ASCII letters (A-Z in
lower case) and all characters beyond ASCII.  A language keeps the terms that at
least ``least`` of its documents hold.  A term's share in a group, with one added
to each count, is ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, and the
divergence of p from q is the sum of ``floor((p - q)^2 / q)`` over the kept terms.

1. Tasks count terms in their own rows before anything is shuffled; each term
   comes with its occurrences and its documents, by group.
2. Kept terms are dealt by hash to vocabulary chunks of about ``CHUNK`` terms and
   numbered within them; a group's counts of a chunk are one packed row.
3. Groups are dealt by hash to blocks of about ``BLOCK`` groups.  A tile is a pair
   of blocks and a stripe of ``STRIPE`` chunks.  Every packed row goes to the tiles
   of its block, sorted by chunk; a task holds one chunk of two blocks at a time
   and adds up the tile's submatrix.  Terms that neither block has count as zeros.
4. Submatrices of the stripes are summed by pair.

The second part compares each group's terms with the whole language and keeps
the ``ranks`` highest.  All numbers are exact integers (below 9.2e15 occurrences
in a language).

Defined results: null text, language and source are empty strings; a group
without terms takes part with zero counts; a language without kept terms gives
pairs of value 0 and no terms; a language with one source gives no pairs; ties go
to the item that is first in UTF-8; repeated rows count as often as they come;
very long texts are counted like others and very long terms are terms; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintel.llm.words import small
from lintel.storage import written

SCALE = 1_000_000_000
LEAST, RANKS = 3, 200
CHUNK, BLOCK, STRIPE = 8_192, 16, 32
#: Distinct terms a task gathers before it sends them on.
GATHERED = 500_000
#: ASCII letters and whatever is beyond ASCII, in lower-cased UTF-8: ``bytes.lower`` changes A-Z only.
_terms = re.compile(rb"[a-z\x80-\xff]+").findall


def _counted(batches):
    """lang, source, term, occurrences and documents, of the rows of a task."""
    kept: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out():
        for (lang, source), (occurrences, documents) in kept.items():
            terms = list(occurrences)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(occurrences.values(), pa.int64()), pa.array(map(documents.__getitem__, terms), pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )
        kept.clear()

    for batch in batches:
        langs, sources, texts = (batch.column(i) for i in range(3))
        for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
            found = _terms(text.as_py().lower())
            occurrences, documents = kept.setdefault((lang, source), (Counter(), Counter()))
            before = len(occurrences)
            occurrences.update(found)
            documents.update(set(found))
            size += len(occurrences) - before
            if size >= GATHERED:
                yield from out()
                size = 0
    yield from out()


def share(n: Column, total: Column) -> Column:
    """p of count ``n``, where ``total`` is N + V; exact in decimals."""
    exact = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.call_function("div", exact, total.cast("decimal(19,0)")).cast("long") + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Counted:
    """The written tables of a corpus: groups, languages, and counts of kept terms."""

    def __init__(self, docs: DataFrame, text: str, lang: str, source: str, least: int):
        blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        rows = docs.select(blank(lang).alias("lang"), blank(source).alias("source"), blank(text).cast("binary").alias("text"))
        counted = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
        counts = written(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
        kept = written(kept.drop("docs"), "divergence-vocabulary")
        # One row for each language: tables of languages are broadcast, as a language may have most rows of the other side.
        chunks = written(kept.groupBy("lang").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "divergence-chunks")
        kept = kept.join(small(chunks), "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))
        # A chunk has about CHUNK terms, by their hashes.
        kept = kept.withColumn("at", F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1)
        self.terms = written(kept.select("lang", "term", "all", "chunk", "at"), "divergence-terms")
        # Groups of counts that hold no kept term stay as groups, from the rows themselves.
        sizes = self.terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("all_n"))
        here = written(rows.select("lang", "source").distinct(), "divergence-names")
        blocks = here.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        self.langs = small(written(blocks.join(sizes, "lang", "left").na.fill(0, ["v", "all_n"]), "divergence-langs"))
        self.counts = written(counts.drop("docs").join(self.terms, ["lang", "term"]), "divergence-kept")
        totals = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = here.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(self.langs, "lang")
        block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
        self.groups = small(written(groups.select("lang", "source", "total", "v", "blocks", block.alias("block")), "divergence-groups"))


def _tiles(rows: DataFrame) -> DataFrame:
    """Each row once for every tile of its block: ``low`` and ``high`` are the tile's blocks."""
    out = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return out.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")


def shares(n: np.ndarray, total: int) -> np.ndarray:
    """p of the counts ``n`` by long division, three digits at a time, so that no product leaves 64 bits."""
    rest, p = n + 1, np.zeros_like(n)
    for _ in range(3):
        rest = rest * 1000
        p = p * 1000 + rest // total
        rest = rest % total
    return p + 1


def _submatrix(rows) -> list[tuple]:
    """All (lang, source, other, value) of one tile's stripe; rows: its groups (chunk -1), then packed counts by chunk."""
    lang, groups, unseen, sums = None, [], 0, None
    for chunk, members in groupby(rows, key=lambda r: r["chunk"]):
        if chunk < 0:
            groups = sorted(members, key=lambda r: (r["block"], r["source"]))
            lang, unseen = groups[0]["lang"], groups[0]["size"]
            index = {g["source"]: i for i, g in enumerate(groups)}
            total = [g["total"] + g["v"] for g in groups]
            sums = np.zeros((len(groups), len(groups)), np.int64)
            continue
        members = list(members)
        size = members[0]["size"]
        unseen -= size
        p = np.zeros((len(groups), size), np.int64)
        for r in members:
            p[index[r["source"]], np.array(r["at"], np.int64)] = r["n"]
        for i, t in enumerate(total):
            p[i] = shares(p[i], t)
        for i in range(len(groups)):
            sums[i] += ((p[i] - p) ** 2 // p).sum(1)
    if unseen:
        p = np.array([shares(np.zeros(1, np.int64), t)[0] for t in total])
        sums += unseen * ((p[:, None] - p) ** 2 // p)
    # A tile of two blocks gives pairs across them; one of a block with itself gives those within.
    across = groups[0]["low"] != groups[0]["high"]
    wanted = [(i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i != j and (not across or a["block"] != b["block"])]
    return [(lang, groups[i]["source"], groups[j]["source"], int(sums[i, j])) for i, j in wanted]


def _swept(batches):
    """Rows sorted by tile and chunk in; the submatrix of each tile out, when its last chunk has passed."""
    rows = (r for batch in batches for r in batch.to_pylist())
    for _, tile in groupby(rows, key=lambda r: (r["lang"], r["low"], r["high"], r["stripe"])):
        if found := _submatrix(tile):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["lang", "source", "item", "value"])


def pairs(counted: Counted) -> DataFrame:
    """lang, source, item (another source) and value."""
    sizes = counted.terms.groupBy("lang", "chunk").agg(F.count("*").cast("int").alias("size"))
    stripes = written(sizes.groupBy("lang", F.floor(F.col("chunk") / STRIPE).cast("int").alias("stripe")).agg(F.sum("size").alias("size")), "divergence-stripes")
    # A language without terms has one stripe of none, so that its pairs come out as 0.
    heads = counted.groups.join(small(stripes), "lang", "left").na.fill(0, ["stripe", "size"])
    none = F.array().cast("array<int>")
    heads = heads.select("lang", "stripe", "blocks", "block", F.lit(-1).alias("chunk"), "source", "total", "v", "size", none.alias("at"), none.cast("array<long>").alias("n"))
    packed = counted.counts.groupBy("lang", "source", "chunk").agg(F.collect_list(F.struct("at", "n")).alias("c")).join(counted.groups, ["lang", "source"]).join(sizes, ["lang", "chunk"])
    packed = packed.select(
        "lang", F.floor(F.col("chunk") / STRIPE).cast("int").alias("stripe"), "blocks", "block", "chunk", "source", "total", "v", F.col("size").cast("long").alias("size"), F.col("c.at").alias("at"), F.col("c.n").alias("n")
    )
    tile = ["lang", "low", "high", "stripe"]
    dealt = _tiles(heads.unionByName(packed)).repartition(*tile).sortWithinPartitions(*tile, "chunk")
    parts = dealt.mapInArrow(_swept, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def terms(counted: Counted) -> DataFrame:
    """lang, source, item (a kept term that the group has more of than the language) and value."""
    langs = counted.langs.select("lang", "all_n")
    rows = counted.counts.join(counted.groups.select("lang", "source", "total", "v"), ["lang", "source"]).join(langs, "lang")
    rows = rows.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total") + F.col("v")).alias("p"), share(F.col("all"), F.col("all_n") + F.col("v")).alias("q"))
    return rows.filter("p > q").select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def audited(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank."""
    counted = Counted(docs, text, lang, source, least)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    first = pairs(counted).withColumn("part", F.lit("pair")).withColumn("rank", rank)
    second = terms(counted).withColumn("part", F.lit("term")).withColumn("rank", rank).filter(F.col("rank") <= ranks)
    return first.unionByName(second).select("lang", "source", "part", "item", "value", "rank")
