"""Approximate nearest neighbours by collision-counting hashing.

A hash function is one random projection, kept as the array of a block's
vectors sorted by it. A query opens in each array a window centred on its own
projection; a vector inside collides with the query. The windows of all arrays
grow together, ``GROWTH`` times a round (virtual rehashing: no array is built
anew), and only the newly covered parts are counted. A vector that collides in
``collisions`` of ``PROJECTIONS`` arrays is verified: its cosine is computed
from the original vectors in double precision.

For vectors of length 1 at distance d a projection differs by a normal
deviate of standard deviation d, so in windows of half-width ``WIDTH`` * R each
vector at a distance of up to R collides independently in each array with
chance 2 * Phi(``WIDTH``) - 1 or more. ``collisions`` is the largest threshold
that such a vector reaches with chance ``RECALL``. A query is done with a block
as soon as R reaches the distance of the k-th best vector verified so far, in
this block or an earlier one of the task; R is cut to that distance, never
beyond it. There is no cap on windows or candidates; a block that leaves a
query with fewer than k vectors at R = 2, the largest distance, is verified
whole.

Queries are a stated set: they pass over the table in blocks of bounded bytes
(``vectors.QUERY_BYTES``); a task returns k rows a query at most, so a hot
vector or id changes neither balance nor volume. Projections are drawn from a
fixed seed and fit nothing; every row is indexed.

Defined results: rows with a null id, a null, empty or zero vector or with null
or non-finite components take no part; vectors of different length do not meet;
rows of the query's own id are not among its neighbours; rows of equal id are
rows of their own. Equal cosines go by the smaller id. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from procura.llm.common import stored
from procura.llm.vectors import by_length, packed, query_blocks

#: Arrays, half-width of a window at radius 1, and the chance that one of the k nearest is verified.
PROJECTIONS, WIDTH, RECALL = 128, 1.0, 0.99
#: First radius and its growth a round.
FIRST_RADIUS, GROWTH = 0.1, 1.5
#: Largest distance of vectors of length 1, and a radius that rounding stays far below.
FARTHEST, LEAST_RADIUS = 2.0, 1e-6


def collisions(arrays: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> int:
    """Largest number of arrays in which a vector inside the radius collides with chance ``recall``."""
    p, sure = math.erf(width / math.sqrt(2)), 0.0
    for n in range(arrays, 0, -1):
        sure += math.comb(arrays, n) * p**n * (1 - p) ** (arrays - n)
        if sure >= recall:
            return n
    return 0


def _scaled(x: np.ndarray) -> np.ndarray | None:
    """``x`` times a power of two, so that its squares neither overflow nor vanish; None for a zero or empty vector."""
    most = np.abs(x).max(initial=0.0)
    return np.ldexp(x, -int(np.frexp(most)[1])) if most else None


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


class _Nearest:
    """The k best (cosine, id) of a query so far."""

    def __init__(self, own: int, k: int) -> None:
        self.own, self.k = own, k
        self.score, self.id = np.zeros(0), np.zeros(0, np.int64)

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        first = np.lexsort((ids, -score))[: self.k]
        self.score, self.id = score[first], ids[first]

    def radius(self) -> float:
        """Distance, of vectors of length 1, that a further vector must not exceed; infinite with fewer than k."""
        return math.sqrt(max(0.0, 2 - 2 * self.score[-1])) if len(self.score) == self.k else math.inf


class _Block:
    """Sorted projection arrays of a block of vectors, laid end to end."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, arrays: int) -> None:
        self.x, self.ids, self.length = x, ids, _lengths(x)
        self.planes = np.random.default_rng([x.shape[1], arrays]).standard_normal((x.shape[1], arrays))
        shadow = np.ascontiguousarray(self.project(x).T)
        order = np.argsort(shadow, axis=1, kind="stable").astype(np.int32)
        shadow = np.take_along_axis(shadow, order, axis=1)
        self.reach = float(np.abs(shadow).max()) + 1
        self.apart = np.arange(arrays) * 3 * self.reach  # one search finds a window's ends in all arrays
        self.order, self.sorted = order.ravel(), (shadow + self.apart[:, None]).ravel()

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x / _lengths(x)[:, None]) @ self.planes

    def _ends(self, at: np.ndarray, side: str) -> np.ndarray:
        return np.searchsorted(self.sorted, np.clip(at, -self.reach, self.reach) + self.apart, side)

    def search(self, q: np.ndarray, near: _Nearest, at: np.ndarray, threshold: int, width: float) -> None:
        """Verify what collides with query ``q``, whose projections are ``at``, until the radius reaches the k-th best."""
        n, own = len(self.ids), math.sqrt((q * q).sum())
        left = right = self._ends(at, "left")
        count, done, radius = np.zeros(n, np.int64), self.ids == near.own, 0.0

        def verify(rows: np.ndarray) -> None:
            done[rows] = True
            near.offer((self.x[rows] * q).sum(axis=1) / (self.length[rows] * own), self.ids[rows])

        while radius < (goal := min(max(near.radius(), LEAST_RADIUS), FARTHEST)):
            radius = min(max(FIRST_RADIUS, radius * GROWTH), goal)
            lo, hi = self._ends(at - width * radius, "left"), self._ends(at + width * radius, "right")
            new = [self.order[a:b] for a, b in zip(np.concatenate([lo, right]).tolist(), np.concatenate([left, hi]).tolist())]
            left, right = lo, hi
            count += np.bincount(np.concatenate(new), minlength=n)
            verify(np.flatnonzero((count >= threshold) & ~done))
        if len(near.score) < near.k:
            verify(np.flatnonzero(~done))


def _search(queries: list[tuple], k: int, arrays: int, width: float, recall: float):
    """(query number, id, score): the nearest of each query among a task's rows (id, packed vector)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        threshold = collisions(arrays, width, recall)
        known = [(np.frombuffer(raw, "<f8"), _Nearest(i, k)) for i, raw in queries]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, x in by_length(batch.column(1).to_pylist()):
                block = _Block(x, ids[at], arrays)
                here = [(q, near) for q, near in known if len(q) == x.shape[1]]
                if here:
                    for (q, near), shadow in zip(here, block.project(np.stack([q for q, _ in here]))):
                        block.search(q, near, shadow, threshold, width)
        sizes = [len(near.id) for _, near in known]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(known), dtype=np.int32), sizes)),
                pa.array(np.concatenate([near.id for _, near in known])),
                pa.array(np.concatenate([near.score for _, near in known])),
            ],
            names=["query", "vec_id", "score"],
        )

    return apply


def nearest(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 5, *, arrays: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each row of ``df`` with ``is_query``."""
    rows = df.select(df[key].cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), df[vector].alias("vec"))
    rows = stored(rows.where("id is not null").mapInArrow(packed(_scaled), "id long, query boolean, vec binary"), "neighbours-rows")
    table, spark, found = rows.select("id", "vec"), df.sparkSession, None
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    for block in query_blocks(stored(rows.where("query").select("id", "vec"), "neighbours-queries")):
        queries = [(r["id"], bytes(r["vec"])) for r in block]
        near = table.mapInArrow(_search(queries, k, arrays, width, recall), "query int, vec_id long, score double")
        near = near.withColumn("rank", first).where(F.col("rank") <= k)
        named = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(queries)], "query int, query_id long")
        near = stored(near.join(named, "query").select("query_id", "rank", "vec_id", "score"), "neighbours-found")
        found = near if found is None else found.unionByName(near)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if found is None else found
