"""Near-duplicate documents by a grouped prefix join over shingle sets.

Two sets link when 100 * common >= 75 * union.  Documents of one set are one
set from the start.

1. Tasks hash the shingles of their documents and send them, packed, to segments
   by hash.  A segment knows which shingles occur in more than one set and how
   often, and sends those back to their documents.
2. A set with fewer than 75 % repeated shingles has no partner and is done.  The
   rest order their shingles by rarity (the unrepeated come first); the
   repeated shingles within the necessary prefix are kept.
3. Sets of equal prefix and size are one group.  Within a group, and for each
   prefix shingle among the groups that have it, members are first verified
   against a few pivots; what that links needs no more comparing.  Of what is
   then still unlinked under a shingle, places out of every partner's reach by
   size or position go; the rest is joined group by group on shingle and band of
   sizes, filtered by size and position, expanded to its members and verified.
   No pair is left out unless its two sets are already in one component.
4. Components of the verified links.

Sets and shingles are named by 64-bit hashes.

Defined results: a text of fewer words than a shingle is one shingle; without
words, or null, a text has no shingles and links with nothing; repeated rows are
copies of each other; rows with a null id take part, and a component's id is its
smallest non-null one; an empty table gives an empty table; other columns of the
input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintel.llm.components import components
from lintel.llm.lm import END, chunks, mixed, tokens
from lintel.storage import written

WORDS, PERCENT = 5, 75
#: Documents in one packed run; their numbers take two bytes.
RUN_DOCS, RUN_SHINGLES = 60_000, 1_000_000
#: Rounds of pivots after the first at most, pairs for each set that need no further
#: round, and the share of the pairs that a round must leave at most for another to follow.
PIVOT_ROUNDS, PAIRS_FOR_EACH, WORTHWHILE = 8, 1, 0.5
#: Bands of sizes between a set and the largest that it can link with.
BANDS = 3
#: Pivots that a set meets in a round after the first.
PIVOTS = 8

_U = np.uint64
PACKED = "to long, chunk long, low binary, high binary, docs binary, keys binary, sizes binary, sets binary"
_KINDS = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
_NAMES = ["to", "chunk", "low", "high", "docs", "keys", "sizes", "sets"]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    grams, starts = tokens(texts)
    out = []
    ends = np.append(starts[1:], len(grams)) - 1
    for a, b in zip(starts, ends):
        w = grams[a:b]
        size = min(words, len(w))
        if not size:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.full(len(w) - size + 1, _U(size))
        for i in range(size):
            h = mixed(h + w[i : len(w) - size + 1 + i])
        out.append(np.unique(h))
    return out


def _set_name(s: np.ndarray) -> int:
    place = np.arange(1, len(s) + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    return int(mixed(np.array([mixed(s + place).sum() + _U(len(s))], np.uint64)).astype(np.int64)[0])


def _rows(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _KINDS)], _NAMES)


def _pack(bits: int, words: int):
    """Packed rows: shingles for each segment, and for each run of documents its ids, sizes and set names."""

    def flush(chunk: int, keys, sets, sizes, names):
        seen, keep = {}, []
        for i, name in enumerate(names):
            if sizes[i] and name not in seen:
                seen[name] = i
                keep.append(i)
        rows = []
        if keep:
            all_ = np.concatenate([sets[i] for i in keep])
            docs = np.repeat(np.array(keep, np.uint16), [sizes[i] for i in keep])
            part = (all_ & _U((1 << bits) - 1)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            all_, docs = all_[order] >> _U(bits), docs[order]
            edges = np.searchsorted(part[order], np.arange((1 << bits) + 1))
            low, high = (all_ & _U(0xFFFFFFFF)).astype(np.uint32), (all_ >> _U(32)).astype(np.uint32)
            rows = [(p, chunk, low[a:b].tobytes(), high[a:b].tobytes(), docs[a:b].tobytes(), None, None, None) for p, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        key = np.array([0 if k is None else k for k in keys], np.int64).tobytes() + np.array([k is None for k in keys]).tobytes()
        return _rows([*rows, ((1 << bits) + chunk, chunk, None, None, None, key, np.array(sizes, np.int64).tobytes(), np.array(names, np.int64).tobytes())])

    def run(batches):
        chunk = TaskContext.get().partitionId() << 24
        keys, sets, sizes, names, held = [], [], [], [], 0
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for some in chunks(batch.column(1).to_pylist()):
                for s in shingle_sets(some, words):
                    keys.append(ids[at])
                    sets.append(s)
                    sizes.append(len(s))
                    names.append(_set_name(s) if len(s) else 0)
                    held += len(s)
                    at += 1
                    if held >= RUN_SHINGLES or len(keys) >= RUN_DOCS:
                        yield flush(chunk, keys, sets, sizes, names)
                        chunk += 1
                        keys, sets, sizes, names, held = [], [], [], [], 0
        if keys:
            yield flush(chunk, keys, sets, sizes, names)

    return run


def _joined(column, kind) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _segment(bits: int):
    """Repeated shingles of a segment, packed for their documents' runs; runs themselves pass through."""
    kinds = [pa.int64(), *[pa.binary()] * 6]
    names = ["chunk", "shingles", "counts", "docs", "keys", "sizes", "sets"]

    def run(table: pa.Table) -> pa.Table:
        to = table["to"][0].as_py()
        if to >= 1 << bits:
            none = pa.nulls(len(table), pa.binary())
            return pa.table([table["chunk"], none, none, none, table["keys"], table["sizes"], table["sets"]], names=names)
        s = _joined(table["low"], np.uint32).astype(np.uint64) | _joined(table["high"], np.uint32).astype(np.uint64) << _U(32)
        docs = _joined(table["docs"], np.uint16)
        chunk = np.repeat(table["chunk"].to_numpy(), [len(x.as_buffer()) // 2 for x in table["docs"]])
        order = np.argsort(s, kind="stable")
        s = s[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        counts = np.diff(np.append(first, len(s)))
        counts = np.repeat(counts, counts)
        many = counts > 1
        s, counts, order = s[many], counts[many], order[many]
        chunk, docs = chunk[order], docs[order]
        s = s << _U(bits) | _U(to)
        order = np.argsort(chunk, kind="stable")
        s, counts, chunk, docs = s[order], counts[order].astype(np.uint32), chunk[order], docs[order]
        which, at = np.unique(chunk, return_index=True)
        rows = [(int(c), s[a:b].tobytes(), counts[a:b].tobytes(), docs[a:b].tobytes(), None, None, None) for c, a, b in zip(which, at, np.append(at[1:], len(s)))]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names=names)

    return run


SETS = "key long, n long, set long, shingles binary, prefix array<long>, at long"


def _documents(percent: int):
    """Each document of a run: id, size, set name, and for sets that can have a partner the repeated shingles and prefix."""

    def run(table: pa.Table) -> pa.Table:
        s, counts, docs = _joined(table["shingles"], np.uint64), _joined(table["counts"], np.uint32), _joined(table["docs"], np.uint16)
        order = np.lexsort((s, counts, docs))
        s, docs = s[order], docs[order]
        out = [[] for _ in range(6)]
        row = next(i for i in range(len(table)) if table["keys"][i].is_valid)
        sizes, sets = (np.frombuffer(table[c][row].as_buffer(), np.int64) for c in ("sizes", "sets"))
        data = table["keys"][row].as_py()
        keys, nulls = np.frombuffer(data[: 8 * len(sizes)], np.int64), np.frombuffer(data[8 * len(sizes) :], bool)
        edges = np.searchsorted(docs, np.arange(len(sizes) + 1))
        for i, n in enumerate(sizes.tolist()):
            mine = s[edges[i] : edges[i + 1]]
            least = -(-n * percent // 100)
            able = n > 0 and len(mine) >= least
            single = n - len(mine)
            row = (None if nulls[i] else int(keys[i]), n, int(sets[i]) if n else None, np.sort(mine).tobytes() if able else None, mine[: n - least + 1 - single].astype(np.int64) if able else None, single if able else None)
            for column, value in zip(out, row):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=["key", "n", "set", "shingles", "prefix", "at"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that link."""

    @F.arrow_udf("boolean")
    def link(na: pa.Array, nb: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for n, m, x, y in zip(na.to_numpy(), nb.to_numpy(), a, b):
            common = len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), True))
            out.append(100 * common >= percent * (n + m - common))
        return pa.array(out, pa.bool_())

    x = sets.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    y = sets.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    return pairs.join(x, "a").join(y, "b").filter(fits).filter(link("na", "nb", "sa", "sb")).select("a", "b")


def _relabelled(labels: DataFrame, links: DataFrame, times: int = 2) -> DataFrame:
    """Every set takes the least label among its links, a number of times; equal labels mean one component."""
    both = links.union(links.select("b", "a"))
    for _ in range(times):
        near = both.join(labels.withColumnRenamed("set", "b"), "b").groupBy("a").agg(F.min("label").alias("m")).withColumnRenamed("a", "set")
        labels = written(labels.join(near, "set", "left").select("set", F.least("label", "m").alias("label")), "jaccard-labels")
    return labels


def _bound(rest: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m shingles can link if they have at most ``rest`` in common."""
    return rest * (100 + percent) >= (n + m) * percent


def _spread(rows: DataFrame, *more: str) -> DataFrame:
    """Keys (s and ``more``) whose rows have several labels: their fewest shingles and longest rest, by side where rows have one."""
    if "band" not in more:
        of = [F.min("n").alias("n_"), F.max("rest").alias("rest_")]
    else:
        of = [f(F.when(F.col("side") == i, F.col(c))).alias(f"{c}{i}") for i in (0, 1) for f, c in ((F.min, "n"), (F.max, "rest"))]
    return rows.groupBy("s", *more).agg(F.min("lo").alias("lo_"), F.max("hi").alias("hi_"), *of).filter("lo_ != hi_").drop("lo_", "hi_")


def _alive(places: DataFrame, labels: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Places of shingles with several labels that some other place of the shingle could reach, with their groups' labels."""
    of_group = members.join(labels, "set").groupBy("group").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"))
    rows = places.select("s", "group", "n", "rest").join(of_group, "group")
    least = F.ceil(F.col("n") * percent / 100)
    for _ in range(2):
        met = rows.join(_spread(rows), "s").filter(_bound(F.least("rest", "rest_"), F.col("n"), F.greatest(least, "n_"), percent))
        rows = written(met.drop("n_", "rest_"), "jaccard-alive")
    return rows


def _open(rows: DataFrame, percent: int) -> DataFrame:
    """Alive places that can still have a partner, by shingle, band of sizes and side (0: the smaller set, 1: the larger).

    A partner's size and position are bounded by the fewest shingles and the
    longest rest among the other side's places, so what no partner can reach goes.
    """
    least = F.ceil(F.col("n") * percent / 100)
    step = math.log(100 / percent) / BANDS or math.log(2)
    band = F.floor(F.log("n") / step).cast("int")
    # A larger partner is at most BANDS bands up; one more for rounding.
    sides = rows.withColumn("side", F.lit(0)).withColumn("band", band).unionByName(rows.withColumn("side", F.lit(1)).withColumn("band", F.explode(F.array(*(band - i for i in range(BANDS + 2))))))
    for _ in range(2):
        other_n, other_rest = (F.when(F.col("side") == 0, F.col(f"{c}1")).otherwise(F.col(f"{c}0")) for c in ("n", "rest"))
        partner = F.greatest(F.when(F.col("side") == 0, F.col("n")).otherwise(least), other_n)
        met = sides.join(_spread(sides, "band"), ["s", "band"]).filter(other_n.isNotNull()).filter(_bound(F.least("rest", other_rest), F.col("n"), partner, percent))
        sides = written(met.drop("n0", "n1", "rest0", "rest1"), "jaccard-open")
    return sides


def linked(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Verified links (a, b) that connect all linked sets. sets: set, n, shingles, prefix, at, group."""
    members = sets.select("set", "group")
    places = sets.select("group", "n", "at", "prefix").dropDuplicates(["group"])
    places = places.select("group", "n", "at", F.posexplode("prefix").alias("i", "s")).select("s", "group", "n", (F.col("n") - F.col("at") - F.col("i")).alias("rest"), F.col("at").alias("single"))
    # Shingles of one group's prefix only join nothing.  The pivot of a shingle is first the group with the fewest
    # unrepeated shingles: that from which the others differ is often among the sets.
    met = places.groupBy("s").agg(F.min(F.struct("single", F.xxhash64("group").alias("h"), "group")).alias("p"), F.count("*").alias("c")).filter("c > 1").select("s", "p")
    places = written(places.drop("single").join(met, "s"), "jaccard-places")
    leaders = members.groupBy("group").agg(F.min("set").alias("b"))
    first = members.join(leaders, "group").filter("set != b").select(F.col("set").alias("a"), "b")
    links = written(_verified(first, sets, percent), "jaccard-links")
    labels = _relabelled(sets.select("set", F.col("set").alias("label")), links, 1)
    enough, before = PAIRS_FOR_EACH * members.count(), math.inf
    few, alive = places.groupBy("group").agg(F.min("p").alias("p")).select("group", F.col("p.group").alias("to")), places
    for turn in range(PIVOT_ROUNDS + 1):
        few = few.join(leaders.withColumnRenamed("group", "to"), "to").select("group", "b")
        label = labels.select(F.col("set").alias("b"), F.col("label").alias("other"))
        pairs = members.join(few, "group").filter("set != b").join(labels, "set").join(label, "b").filter("label != other").select(F.col("set").alias("a"), "b").distinct()
        more = written(_verified(pairs, sets, percent), "jaccard-links")
        links = links.union(more)
        labels = _relabelled(labels, more)
        # Labels only merge, so what is out of reach stays so.
        alive = _alive(alive, labels, members, percent)
        open_ = _open(alive, percent)
        counts = open_.groupBy("s", "band").agg(F.sum(F.when(F.col("side") == 0, F.col("m"))).alias("x"), F.sum(F.when(F.col("side") == 1, F.col("m"))).alias("y"))
        left = counts.agg(F.sum(F.col("x") * F.col("y"))).first()[0] or 0
        if left <= enough or left > WORTHWHILE * before:
            break
        before = left
        drawn = open_.groupBy("s", "band").agg(F.min(F.struct(F.xxhash64("group", "s", F.lit(turn)).alias("h"), "group")).alias("p"))
        asked = open_.select("s", "band", "group").join(drawn, ["s", "band"])
        # Of its shingles' pivots, a set meets the first few.
        few = asked.groupBy("group").agg(F.array_sort(F.collect_set("p")).alias("p")).select("group", F.explode(F.slice("p.group", 1, PIVOTS)).alias("to"))
    x, y = (open_.filter(F.col("side") == i).select("s", "band", *(F.col(c).alias(f"{c}{i}") for c in ("group", "n", "rest", "lo", "hi"))) for i in (0, 1))
    fits = (F.col("n0") * 100 >= F.col("n1") * percent) & _bound(F.least("rest0", "rest1"), F.col("n0"), F.col("n1"), percent)
    met = x.join(y, ["s", "band"]).filter("n0 < n1 or n0 = n1 and group0 <= group1").filter("not (lo0 = hi0 and lo1 = hi1 and lo0 = lo1)").filter(fits).select("group0", "group1").distinct()
    m0, m1 = (members.join(labels, "set").select(F.col("group").alias(f"group{i}"), F.col("set").alias("ab"[i]), F.col("label").alias(f"label{i}")) for i in (0, 1))
    pairs = met.join(m0, "group0").join(m1, "group1").filter("label0 != label1 and a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return links.union(written(_verified(pairs, sets, percent), "jaccard-links"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Columns key, n_shingles and component_id (the smallest key reachable by links), a row for each row of ``docs``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(24, max(5, math.ceil(math.log2(2 * parts))))
    packed = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(_pack(bits, words), PACKED)
    back = packed.groupBy("to").applyInArrow(_segment(bits), "chunk long, shingles binary, counts binary, docs binary, keys binary, sizes binary, sets binary")
    rows = written(back.groupBy("chunk").applyInArrow(_documents(percent), SETS), "jaccard-sets")
    able = rows.filter("shingles is not null").dropDuplicates(["set"]).select("set", "n", "shingles", "prefix", "at", F.xxhash64("n", "prefix").alias("group"))
    able = written(able, "jaccard-able")
    roots = components(linked(able, percent)).select(F.col("node").alias("set"), "root")
    least = written(rows.filter("set is not null").groupBy("set").agg(F.min("key").alias("k")).join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")), "jaccard-roots")
    ids = least.groupBy("root").agg(F.min("k").alias("component_id"))
    named = least.join(ids, "root").select("set", "component_id")
    out = rows.select("key", "n", "set").join(named, "set", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id")).alias("component_id"))
