"""N-gram Jaccard join by grouped prefixes.

Documents are sets of word shingles. Two link when
100 * |intersection| >= PERCENT * |union|, decided exactly in integers.

1. *Order.* All shingles are counted into a table of fixed size by hash; rare
   ones come first in the order (count, hash) that prefixes are taken in. Any
   total order gives whole results, a good one few candidates.
2. *Collapse.* Equal sets become one; sets with the same size and the same
   prefix become one group. Only groups are joined.
3. *Filter.* Two groups are candidates if, within their prefixes, they share
   ``SHARED`` shingles (or all that they need if that is fewer) at positions
   that still allow the threshold, and their sizes are compatible.
4. *Hubs first.* Every group is paired with the group that comes first for the
   most of its shingles, every set with the first of its group: linearly many
   pairs. Verified, they join most near copies into components.
5. *Rest.* Candidate pairs are then made only between different components;
   shingles that lie in one component alone are dropped before the join. So
   the pairs inside a large group of near copies are never made, and no link
   between components is lost.
6. *Verify.* The full sets of the candidates are made again from the texts and
   intersected.

Defined results: words are maximal runs of bytes other than 0x20 and
0x09-0x0D, A-Z folded; a text with fewer than ``SHINGLE`` words is one shingle,
a null, empty or blank text has the empty set and links with nothing; equal
sets always link; ids that are null are never the least id of a component
unless it has no other; rows of equal id are separate documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.llm.common import least_reachable, stored
from procura.llm.textops import digest, distinct_of, shingles_of, slices, space_words, words_of

#: Cells of the count table (fixed size: 8 MB), and the parts it is shuffled in.
COUNT_BITS, COUNT_PARTS = 21, 32
#: Shingles that a candidate pair has to share within its prefixes.
SHARED = 2
#: Bits of a group's number (partition << 33 + row) when it is packed with a position.
GID_BITS = 50
#: Candidates up to this number are sent to all tasks to pick their texts; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def _sets(column, k: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_of(*shingles_of(*words_of(column, space_words), k))


def _ceil_div(a, b):
    return -(-a // b)


def needed(a: Column, b: Column, percent: int) -> Column:
    """Least intersection of linked sets of sizes a and b: ceil(percent * (a + b) / (100 + percent))."""
    return F.ceil((percent * (a + b)) / F.lit(100 + percent)).cast("bigint")


def shingle_counts(docs: DataFrame, text: str, k: int) -> np.ndarray:
    """Counts of all shingles of all documents by the top bits of their hash.

    Each task adds up its own table and sends it compressed in parts; parts
    are summed in two levels. What reaches the driver has a fixed size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for i, n in slices(batch.column(0)):
                values, _ = _sets(batch.column(0).slice(i, n), k)
                table += np.bincount((values >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(table))
        if table.any():
            parts = [zlib.compress(p.astype("<u4").tobytes(), 1) for p in np.split(table, COUNT_PARTS)]
            place = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays([pa.array(range(COUNT_PARTS), pa.int32()), pa.array([place] * COUNT_PARTS, pa.int32()), pa.array(parts, pa.binary())], names=["part", "level", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c.as_py()), "<u4").astype(np.int64) for c in table.column("counts"))
        raw = zlib.compress(np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes(), 1)
        return pa.table({"part": table.column("part")[:1], "level": pa.array([0], pa.int32()), "counts": pa.array([raw], pa.binary())})

    schema = "part int, level int, counts binary"
    parts = docs.select(text).mapInArrow(count, schema).groupBy("part", "level").applyInArrow(add, schema).groupBy("part").applyInArrow(add, schema)
    out = np.zeros(1 << COUNT_BITS, np.uint32)
    width = len(out) // COUNT_PARTS
    for row in parts.collect():
        out[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zlib.decompress(bytes(row["counts"])), "<u4")
    return out


def signatures(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """(id, n, sid, grp, prefix): set size, the set's digest, the group's hash and the prefix, rarest shingle first."""
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, text, k))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in batches:
            for i, n in slices(batch.column(1)):
                part = batch.slice(i, n)
                values, first = _sets(part.column(1), k)
                rarity = table[(values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                sizes = np.diff(first)
                # a set of n linked to one of its size or smaller shares ceil(percent * n / 100) shingles at least
                lengths = np.minimum(sizes, sizes - _ceil_div(percent * sizes, 100) + SHARED)
                sids, groups, prefixes = [], [], []
                for a, b, length in zip(first[:-1], first[1:], lengths, strict=True):
                    own = values[a:b]
                    prefix = own[np.argsort(rarity[a:b], kind="stable")[:length]]
                    sids.append(digest(own.tobytes()))
                    groups.append(int.from_bytes(digest(prefix.tobytes() + len(own).to_bytes(8, "little"))[:8], "little", signed=True))
                    prefixes.append(prefix.view(np.int64))
                flat = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(p) for p in prefixes])), pa.int32()), pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(sids, pa.binary()), pa.array(groups, pa.int64()), flat], names=["id", "n", "sid", "grp", "prefix"])

    source = docs.select(docs[key].cast("bigint").alias("id"), docs[text].alias("text"))
    return source.mapInArrow(run, "id long, n long, sid binary, grp long, prefix array<long>")


def _sets_of(docs: DataFrame, key: str, text: str, k: int, sids: DataFrame) -> DataFrame:
    """(sid, shingles): the sorted sets named by ``sids`` (sid, rep), made again from the texts of the ids ``rep``.

    Up to BROADCAST_ROWS named sets go to all tasks; more meet the texts by a shuffle.
    """
    wanted = _small(sids.select("rep").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n in slices(batch.column(0)):
                values, first = _sets(batch.column(0).slice(i, n), k)
                raw = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([digest(r) for r in raw], pa.binary()), pa.array(raw, pa.binary())], names=["sid", "shingles"])

    source = docs.select(docs[key].cast("bigint").alias("id"), docs[text].alias("text"))
    picked = source.join(wanted, F.col("id").eqNullSafe(F.col("rep")), "left_semi").select("text")
    made = picked.mapInArrow(run, "sid binary, shingles binary").join(sids.select("sid"), "sid", "left_semi")
    return made.dropDuplicates(["sid"])


def _linked(docs: DataFrame, key: str, text: str, k: int, percent: int, pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Of the set pairs (a, b), those that link: intersected exactly, each pair by itself."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(reps, "sid")
    sets = stored(_sets_of(docs, key, text, k, stored(named, "ngram-wanted")), "ngram-sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    one = pairs.join(sets.select(F.col("sid").alias("a"), F.col("shingles").alias("x")), "a")
    two = one.join(sets.select(F.col("sid").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    return stored(two.mapInArrow(run, "a binary, b binary"), "ngram-links")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _compatible(x: str, y: str, percent: int) -> Column:
    """The filter on two postings (n, pos) of one shingle: sizes, and what can still follow in both sets.

    ``x`` is the smaller set; within the pair's own prefix the shingle must be
    among its first n - needed + SHARED.
    """
    nx, ny, px, py = (F.col(f"{s}.{c}") for c in ("n", "pos") for s in (x, y))
    need = needed(nx, ny, percent)
    return (100 * nx >= percent * ny) & (nx - px - 1 + SHARED >= need) & (ny - py - 1 + SHARED >= need)


def components(docs: DataFrame, key: str, text: str, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(signatures, (sid, component)): the component of every linked set, named by a set's digest."""
    rows = stored(signatures(docs, key, text, k, percent), "ngram-signatures")
    full = rows.where("n > 0")
    groups = full.select("grp", "n", "prefix").dropDuplicates(["grp", "n"])
    groups = stored(groups.withColumn("gid", F.monotonically_increasing_id()), "ngram-groups")
    members = full.groupBy("sid", "grp", "n").agg(F.min("id").alias("rep")).join(groups.select("grp", "n", "gid"), ["grp", "n"])
    members = stored(members.select("sid", "gid", "n", "rep"), "ngram-members")
    reps = members.select("sid", "rep")
    postings = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    # of the groups that have a shingle, the hub is the one that has it earliest in its prefix
    early = F.shiftleft(F.least("pos", F.lit((1 << 63 - GID_BITS) - 1)).cast("bigint"), GID_BITS).bitwiseOR(F.col("gid"))
    shared = postings.groupBy("token").agg(F.min("gid").alias("l"), F.max("gid").alias("h"), F.min(early).alias("early")).where("l != h")
    shared = shared.select("token", F.col("early").bitwiseAND(F.lit((1 << GID_BITS) - 1)).alias("hub"))
    postings = stored(postings.join(shared, "token").select("token", "gid", "n", "pos", "hub"), "ngram-postings")

    # hubs first
    met = postings.where("gid != hub").groupBy("gid", "hub").agg(F.count(F.lit(1)).alias("times"))
    best = met.groupBy("gid").agg(F.max(F.struct("times", "hub")).alias("best")).select("gid", F.col("best.hub").alias("hub"))
    first_set = members.groupBy("gid").agg(F.min("sid").alias("first"), F.max("n").alias("n"))
    star = members.select("gid", "sid", "n").join(best, "gid").join(first_set.select(F.col("gid").alias("hub"), "first", F.col("n").alias("hub_n")), "hub")
    star = star.where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")).select(*_ordered("sid", "first"))
    inside = members.join(first_set.select("gid", "first"), "gid").where("sid != first").select(*_ordered("sid", "first"))
    early_links = _linked(docs, key, text, k, percent, stored(star.unionByName(inside).distinct(), "ngram-hub-pairs"), reps)
    known = least_reachable(early_links, "ngram-hubs")

    # the rest: only between different components
    placed = members.join(known.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "gid", F.coalesce("component", "sid").alias("comp"))
    placed = stored(placed, "ngram-placed")
    of_group = placed.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    told = postings.drop("hub").join(of_group, "gid")
    mixed = told.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l != h").select("token")
    open_ = stored(told.join(mixed, "token"), "ngram-open")
    x, y = open_.alias("x"), open_.alias("y")
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.gid") < F.col("y.gid")))
    apart = ~((F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low")))
    found = x.join(y, (F.col("x.token") == F.col("y.token")) & smaller & apart & _compatible("x", "y", percent))
    found = found.groupBy(F.col("x.gid").alias("gx"), F.col("y.gid").alias("gy"), F.col("x.n").alias("nx"), F.col("y.n").alias("ny")).agg(F.count(F.lit(1)).alias("times"))
    found = found.where(F.col("times") >= F.least(F.lit(SHARED), needed(F.col("nx"), F.col("ny"), percent))).select("gx", "gy")
    px, py = (placed.select(F.col("gid").alias(f"g{s}"), F.col("sid").alias(f"s{s}"), F.col("comp").alias(f"c{s}")) for s in ("x", "y"))
    across = found.join(px, "gx").join(py, "gy").where("cx != cy").select(*_ordered("sx", "sy"))
    split = of_group.where("low != high").select("gid")
    one, two = (placed.join(split, "gid", "left_semi").select("gid", F.col("sid").alias(f"s{s}"), F.col("comp").alias(f"c{s}")) for s in ("x", "y"))
    within = one.join(two, "gid").where("sx < sy and cx != cy").select(*_ordered("sx", "sy"))
    late = _linked(docs, key, text, k, percent, stored(across.unionByName(within).distinct(), "ngram-rest"), reps)
    return rows, least_reachable(early_links.unionByName(late), "ngram-all")


def jaccard_classes(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """(``key``, n_shingles, component_id, class_size): one row per row of ``docs``.

    ``component_id`` is the least id of the document's component, itself included.
    """
    rows, linked = components(docs, key, text, k, percent)
    full = rows.where("n > 0").select("id", "n", "sid")
    placed = full.join(linked.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    classes = placed.groupBy("component").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("class_size"))
    out = placed.join(classes, "component").select("id", "n", "component_id", "class_size")
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"), F.lit(1).cast("bigint").alias("class_size"))
    return out.unionByName(empty).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", "class_size")


def one_of_each(docs: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """The rows of ``docs`` without those that are not the first of their class.

    The first is the row of least id, then of least set digest; of rows with
    equal id and equal set one stays. Documents without words all stay. An id
    whose rows all go, or all stay, is settled by a join on the id alone; only
    the rows of ids with both kinds are hashed again.
    """
    rows, linked = components(docs, key, text, k, percent)
    full = rows.where("n > 0").groupBy("id", "sid").agg(F.count(F.lit(1)).alias("copies"))
    placed = full.join(linked.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    # null ids come last
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "sid")
    classes = placed.groupBy("component").agg(F.min(rank).alias("first"))
    placed = stored(placed.join(classes, "component").withColumn("stays", rank == F.col("first")), "ngram-classes")
    empty = rows.where("n = 0").select("id", F.lit(True).alias("stays"), F.lit(1).cast("bigint").alias("copies")).distinct()
    by_id = placed.select("id", "stays", "copies").unionByName(empty).groupBy(F.col("id").alias("__id"))
    by_id = by_id.agg(F.bool_and(~F.col("stays")).alias("all_go"), F.bool_or(~F.col("stays") | (F.col("copies") > 1)).alias("some_go"))
    by_id = stored(by_id.where("some_go"), "ngram-ids")
    of_id = F.col(key).cast("bigint").eqNullSafe(F.col("__id"))
    kept = docs.join(_small(by_id.where("all_go").select("__id")), of_id, "left_anti")
    mixed = by_id.where("not all_go").select("__id")
    if not mixed.head(1):
        return kept
    mixed = _small(mixed)
    gone = placed.where("not stays").select(F.col("id").alias("__id"), F.col("sid").alias("__gone"))
    again = placed.where("stays and copies > 1").select(F.col("id").alias("__id"), F.col("sid").alias("__gone"))
    same = of_id & (F.col("__sid") == F.col("__gone"))
    named = _with_digest(kept.join(mixed, of_id, "left_semi"), text, k).join(_small(gone), same, "left_anti")
    if again.head(1):
        single = named.join(_small(again), same, "left_semi").dropDuplicates([key, "__sid"])
        named = named.join(_small(again), same, "left_anti").unionByName(single)
    return kept.join(mixed, of_id, "left_anti").unionByName(named.drop("__sid"))


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has at most BROADCAST_ROWS rows, as counted."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _with_digest(docs: DataFrame, text: str, k: int) -> DataFrame:
    names = docs.columns
    fields = "".join(f"`{c}` {t}, " for c, t in docs.dtypes)
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n in slices(batch.column(at)):
                part = batch.slice(i, n)
                values, first = _sets(part.column(at), k)
                sids = [digest(values[a:b].tobytes()) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sids, pa.binary())], names=[*names, "__sid"])

    return docs.mapInArrow(run, f"{fields}`__sid` binary")
