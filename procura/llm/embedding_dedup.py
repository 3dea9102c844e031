"""Embedding near-duplicates by sorted projection passes.

In every pass a vector's key is a row of random hyperplane signs, and all
vectors of equal key are compared with each other; pairs whose cosine, in
double precision, reaches the threshold are linked, and components follow.

Keys have as many signs as leave about ``WINDOW`` vectors a key if the vectors
are spread evenly. Where they are not, a run of equal keys is longer: it is cut
into chunks by a hash, and every two chunks are compared in a task of their
own, so that no pair of equal keys is left out. The number of passes follows
from the signs alone: a pair at the threshold shares a key in some pass with
chance ``RECALL`` or more, wherever it lies and however dense its surroundings
are. A pair counts only in the first pass in which it shares a key, so a task
returns each row's number of links and a spanning forest of them, which is
linear in its rows where the links grow with the square of a group.

Equal vectors are collapsed to one beforehand, so a vector with very many
copies is one row; copies count as links to each other.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing, and vectors of different length do
not link; a null id takes part, and is the least id only of a component of
null ids; rows of equal id count as copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procura.llm.common import least_reachable, stored

#: Vectors of a key if they are spread evenly, and the chance to find a pair at the threshold.
WINDOW = 1024
RECALL = 0.999
#: With more vectors than these passes allow signs for, a key has more vectors; nothing is left out.
MAX_PASSES = 64
#: A run of n equal keys over the window is cut into sqrt(n / SPREAD) chunks, and into more where one would be over CHUNK rows.
SPREAD, CHUNK = 128, 4096
#: Rows of a chunk whose cosines are held at a time.
STRIP = 512


def _passes(bits: int, threshold: float, recall: float) -> int:
    """Passes after which a pair at the threshold shared all signs of a key with chance ``recall``: each with chance 1 - angle / pi."""
    found = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if found >= 1 else max(2, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def bits_for(rows: int, threshold: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Signs of a key: log2(rows / window), or as many as ``MAX_PASSES`` allow."""
    bits = max(0, round(math.log2(max(1.0, rows / window))))
    while bits and _passes(bits, threshold, recall) > MAX_PASSES:
        bits -= 1
    return bits


def passes_for(rows: int, threshold: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the threshold shared a key with chance ``recall``."""
    return _passes(bits_for(rows, threshold, window, recall), threshold, recall)


def _planes(dim: int, runs: int, bits: int) -> np.ndarray:
    return np.random.default_rng([dim, bits]).standard_normal((runs * bits, dim)).T


def _can_link(batch: pa.RecordBatch) -> list[np.ndarray | None]:
    """Each row's vector as doubles, or None if it links with nothing."""
    out: list[np.ndarray | None] = []
    for v in batch.column(1):
        x = v.values.cast(pa.float64()).to_numpy(zero_copy_only=False) if v.is_valid else None
        out.append(x if x is not None and len(x) and np.isfinite(x).all() and np.any(x) else None)
    return out


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vec: packed doubles) of the vectors that can link."""
    for batch in batches:
        rows = _can_link(batch)
        keep = [i for i, x in enumerate(rows) if x is not None]
        packed = [(rows[i] + 0.0).astype("<f8").tobytes() for i in keep]  # -0.0 becomes 0.0
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(packed, pa.binary())], names=["id", "vec"])


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # the largest component first, so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keyed(runs: int, bits: int):
    """(dim, keys, grp, copies, vec): each row's keys of all passes."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = (1 << np.arange(bits)).astype(np.int64)
        for batch in batches:
            sizes = np.array([len(r) // 8 for r in batch.column(2).to_pylist()], np.int64)
            for dim in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                signs = _unit(part.column(2).to_pylist()) @ _planes(int(dim), runs, bits) > 0
                keys = (signs.reshape(part.num_rows, runs, bits) @ place).ravel()
                at = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * runs)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, dim, np.int32)), pa.ListArray.from_arrays(at, pa.array(keys)), *part.columns], names=["dim", "keys", "grp", "copies", "vec"])

    return apply


def _spanning(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of pairs that connect what the pairs of ``hit`` connect: all of them, or a forest if they are many."""
    if np.count_nonzero(hit) <= 4 * sum(hit.shape):
        return np.nonzero(hit)
    a, b = [], []
    rows, columns = hit.any(axis=1), np.ones(hit.shape[1], bool)
    for i in np.flatnonzero(rows):
        front = np.array([i])[rows[i : i + 1]]
        rows[i] = False
        while len(front):
            out = hit[front] & columns
            new = np.flatnonzero(out.any(axis=0))
            columns[new] = False
            a.append(front[out[:, new].argmax(axis=0)] if len(new) else new)
            b.append(new)
            back = hit[:, new] & rows[:, None]
            front = np.flatnonzero(back.any(axis=1))
            rows[front] = False
            a.append(front)
            b.append(new[back[front].argmax(axis=1)] if len(front) else front)
    return np.concatenate(a), np.concatenate(b)


def _compared(run: int, threshold: float):
    """Rows' numbers of links (grp, others) and links that connect them (grp, b) of one chunk, or of one with another."""

    def apply(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        same = table.column("lo")[0].as_py() == table.column("hi")[0].as_py()
        ids, copies = table.column("grp").to_numpy(), table.column("copies").to_numpy().astype(float)
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(side), -1)
        left, right = (np.arange(len(side)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        hit = np.zeros((len(left), len(right)), bool)
        if hit.size:
            x = _unit(table.column("vec").to_pylist())
            for i in range(0, len(left), STRIP):
                part = x[left[i : i + STRIP]] @ x[right].T >= threshold
                if part.any():
                    for q in range(run):  # counted in an earlier pass
                        part &= keys[left[i : i + STRIP], q][:, None] != keys[right, q]
                hit[i : i + STRIP] = part
            if same:
                hit = np.triu(hit, 1)
                hit |= hit.T
        others = np.zeros(len(side))
        for i in range(0, len(left), STRIP):
            part = hit[i : i + STRIP].astype(float)
            others[left[i : i + STRIP]] += part @ copies[right]
            if not same:
                others[right] += copies[left[i : i + STRIP]] @ part
        some = np.flatnonzero(others)
        a, b = _spanning(hit)
        n, m = len(some), len(a)
        return pa.table(
            {
                "grp": pa.array(np.concatenate([ids[some], ids[left][a]])),
                "others": pa.array(np.concatenate([others[some].astype(np.int64), np.zeros(m, np.int64)])),
                "b": pa.array(np.concatenate([np.zeros(n, np.int64), ids[right][b]]), mask=np.arange(n + m) < n),
            }
        )

    return apply


def near_links(vectors: DataFrame, threshold: float, window: int = WINDOW, passes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Of the rows of ``vectors`` (grp long, copies long, vec binary of doubles): (grp, others) copies linked with each, and (a, b) links that connect them."""
    rows = vectors.count()
    bits = bits_for(rows, threshold, window)
    runs = (passes or passes_for(rows, threshold, window)) if bits else 1  # without signs all have one key
    keyed = stored(vectors.select("grp", "copies", "vec").mapInArrow(_keyed(runs, bits), "dim int, keys array<long>, grp long, copies long, vec binary"), "embedding-keys")
    sizes = keyed.select("dim", F.posexplode("keys").alias("run", "key")).groupBy("run", "dim", "key").count()
    chunks = F.ceil(F.greatest(F.sqrt(F.col("count") / SPREAD), F.col("count") / CHUNK))
    long_runs = stored(sizes.where(F.col("count") > window).select("run", "dim", "key", chunks.alias("chunks")), "embedding-runs")
    found = None
    for run in range(runs):
        one = keyed.withColumn("key", F.col("keys")[run]).join(long_runs.where(F.col("run") == run).drop("run"), ["dim", "key"], "left")
        one = one.withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("grp", F.lit(run)), "chunks"))
        one = one.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        one = one.select("dim", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"), "grp", "copies", "keys", "vec")
        seen = stored(one.groupBy("dim", "key", "lo", "hi").applyInArrow(_compared(run, threshold), "grp long, others long, b long"), "embedding-pass")
        found = seen if found is None else found.unionByName(seen)
    degree = found.where("b is null").groupBy("grp").agg(F.sum("others").alias("others"))
    links = found.where("b is not null").select(F.least("grp", "b").alias("a"), F.greatest("grp", "b").alias("b"))
    return degree, stored(links.distinct(), "embedding-links")


def near_duplicates(df: DataFrame, key: str, vector: str, threshold: float, window: int = WINDOW, passes: int | None = None) -> DataFrame:
    """(``key``, n_links, component_id, kept): one row per row of ``df``."""
    rows = df.select(df[key].cast("bigint").alias("id"), df[vector].alias("vector"))
    usable = stored(rows.mapInArrow(_usable, "id long, vec binary"), "embedding-vectors")
    # equal vectors form one group; its number is fixed by the stored table
    groups = usable.groupBy("vec").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    groups = stored(groups.withColumn("grp", F.monotonically_increasing_id()), "embedding-groups")
    degree, links = near_links(groups.select("grp", "copies", "vec"), threshold, window, passes)
    member = least_reachable(links, "embedding-components").withColumnRenamed("node", "grp")
    told = groups.join(degree, "grp", "left").join(member, "grp", "left").withColumn("component", F.coalesce("component", "grp"))
    least = told.groupBy("component").agg(F.min("least").alias("component_id"))
    told = told.join(least, "component").select("vec", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    named = usable.join(told, "vec").select("id", "n_links", "component_id")
    unlinked = rows.select("id", "vector").mapInArrow(_unusable, "id long").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return named.unionByName(unlinked).select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("id").isNull() & F.col("component_id").isNull()).alias("kept"))


def _unusable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bad = [i for i, x in enumerate(_can_link(batch)) if x is None]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(bad, pa.int64()))], names=["id"])
