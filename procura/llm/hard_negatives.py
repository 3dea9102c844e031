"""Hard-negative mining by Fagin's threshold algorithm.

Every component x of a vector becomes the integer floor(scale * x); the score
of a row for an anchor is their integer inner product. A row's rank follows
from the score, larger first, and among equal scores from the id, smaller
first. An anchor's positives are its first rows of its own label; the negatives
of a positive are the first rows of other labels whose score lies in a window
that the positive's score fixes.

The rows of a task come in blocks. A block holds one list of its rows per
dimension, sorted by component. An anchor reads each list from the end its own
component's sign asks for, one depth after the other; every row it meets is
scored at once (random access). The scores that components at the current depth
would give bound the score of all rows not met yet: once that threshold is
strictly below the last score kept of each window (below the window itself
while it is not full), the anchor is done with the block. What was kept goes
along to the task's next block. An anchor that met no such point in the depths
of ``DEPTHS`` reads the lists to their ends, which is one product of matrices.

Anchors are a stated query set: they pass over the table in blocks of bounded
bytes (``vectors.QUERY_BYTES``), first for their positives, then for the
negatives. A task returns at most the rows it keeps, so a hot label, a hot
vector or a hot id changes neither the balance nor the volume.

Defined results: rows with a null id or label, a null vector, or a null or
non-finite component take no part; vectors of different length do not meet; an
empty vector scores 0. Rows of equal id are rows of their own, but never among
the other rows of an anchor of that id. Integers are exact: products beyond 53
bits are summed as Python integers, and scores outside 64 bits saturate. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from procura.llm.common import stored
from procura.llm.vectors import EXACT, by_length, packed, query_blocks

#: Row entries met, as parts of a block's rows, after which an anchor looks at its threshold.
DEPTHS = (1 / 16, 1 / 4, 1.0)
#: Anchors that are scored against a whole block at a time.
STRIP = 64
#: Largest score; scores beyond it, and below its negative, saturate.
MOST = (1 << 63) - 1
KEPT_SCHEMA = "anchor int, win int, id long, score long"


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of integer-valued doubles as int64, exact; saturated outside 64 bits."""
    if a.size == 0 or b.size == 0:
        return np.zeros((*a.shape[:-1], *b.shape[1:]), np.int64)
    with np.errstate(over="ignore"):
        small = np.abs(a).max() * np.abs(b).max() * a.shape[-1] < EXACT
    if small:
        return (a @ b).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a) @ whole(b), -MOST, MOST).astype(np.int64)


def _integers(scale: float):
    def prepare(x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.nan_to_num(np.floor(scale * x))

    return prepare


class _Kept:
    """What one anchor keeps of each window: at most ``k`` (score, id), best first."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, k: int) -> None:
        self.lo, self.hi, self.k = lo, hi, k
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in lo]

    def bar(self) -> int:
        """A score below this changes nothing."""
        return min((int(s[-1]) if len(s) == self.k else int(lo) for (s, _), lo, hi in zip(self.best, self.lo, self.hi) if lo <= hi), default=MOST)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = np.flatnonzero((scores >= self.bar()) & (scores <= self.hi.max()))
        if not len(some):
            return
        scores, ids = scores[some], ids[some]
        order = np.lexsort((ids, -scores))
        scores, ids = scores[order], ids[order]
        for w, (s, i) in enumerate(self.best):
            at = np.searchsorted(-scores, -self.hi[w], "left")
            new = slice(at, at + self.k)
            s, i = np.concatenate([s, scores[new]]), np.concatenate([i, ids[new]])
            first = np.lexsort((i, -s))[: self.k]
            first = first[s[first] >= self.lo[w]]
            self.best[w] = (s[first], i[first])


def _block(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, anchors: list[tuple], kept: list[_Kept], same: bool, depths=DEPTHS) -> None:
    """Offer the rows of a block to every anchor that their scores can still change."""
    n, dim = x.shape
    order = np.argsort(x, axis=0, kind="stable")
    lists = np.take_along_axis(x, order, axis=0)
    matrix = np.stack([a[3] for a in anchors])
    up, down = np.minimum(matrix, 0), np.maximum(matrix, 0)  # read ascending where the anchor is negative
    steps = [0, *sorted({min(n - 1, int(part * n / max(dim, 1))) for part in depths} - {0})]
    bound = [_exact(np.hstack([up, down]), np.concatenate([lists[t], lists[n - 1 - t]])) for t in steps]

    def allowed(a: tuple) -> np.ndarray:
        return ((labels == a[1]) if same else (labels != a[1])) & (ids != a[0])

    through = []
    for i, a in enumerate(anchors):
        if bound[0][i] < kept[i].bar():
            continue
        ok, seen = allowed(a), np.zeros(n, bool)
        for t0, t1, threshold in zip(steps, steps[1:], bound[1:]):
            met = np.zeros(n, bool)
            met[order[t0:t1, a[3] < 0].ravel()] = True
            met[order[n - t1 : n - t0, a[3] > 0].ravel()] = True
            met &= ~seen
            seen |= met
            rows = np.flatnonzero(met & ok)
            kept[i].offer(_exact(x[rows], a[3]), ids[rows])
            if threshold[i] < kept[i].bar():
                break
        else:
            through.append((i, ok & ~seen))
    for j in range(0, len(through), STRIP):
        part = through[j : j + STRIP]
        scores = _exact(matrix[[i for i, _ in part]], x.T)
        for row, (i, rest) in zip(scores, part):
            kept[i].offer(row[rest], ids[rest])


def _mine(anchors: list[tuple], windows: list[tuple[np.ndarray, np.ndarray]], k: int, same: bool):
    """(anchor number, window, id, score): what a task's rows (id, label, packed vector) give each anchor."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [(i, label, number, np.frombuffer(raw, "<f8")) for number, (i, label, raw) in enumerate(anchors)]
        kept = [_Kept(lo, hi, k) for lo, hi in windows]
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for at, x in by_length(batch.column(2).to_pylist()):
                here = [a for a in known if len(a[3]) == x.shape[1] and len(kept[a[2]].lo)]
                if here:
                    _block(x, ids[at], labels[at], here, [kept[a[2]] for a in here], same)
        out = [(number, w, s, i) for number, one in enumerate(kept) for w, (s, i) in enumerate(one.best) if len(s)]
        sizes = [len(s) for _, _, s, _ in out]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array([o[0] for o in out], np.int32), sizes)),
                pa.array(np.repeat(np.array([o[1] for o in out], np.int32), sizes)),
                pa.array(np.concatenate([o[3] for o in out] or [np.zeros(0, np.int64)])),
                pa.array(np.concatenate([o[2] for o in out] or [np.zeros(0, np.int64)])),
            ],
            names=["anchor", "win", "id", "score"],
        )

    return apply


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest integer n with low * score <= 100 * n <= high * score."""
    lo, hi = -((-low * score) // 100), (high * score) // 100
    return max(lo, -MOST), min(hi, MOST)


def mine(
    df: DataFrame, key: str, label: Column, vector: str, is_anchor: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each row of ``df`` with ``is_anchor``: of each of its first
    ``positives`` rows of equal ``label``, the first ``negatives`` rows of
    another label with low * positive_score <= 100 * score <= high * positive_score.
    """
    rows = df.select(df[key].cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), df[vector].alias("vec"))
    rows = rows.where("id is not null and label is not null").mapInArrow(packed(_integers(scale)), "id long, label long, anchor boolean, vec binary")
    rows = stored(rows, "negatives-rows")
    table = rows.select("id", "label", "vec")
    spark, found = df.sparkSession, None
    schema = "anchor int, anchor_id long, win int, positive_id long, positive_score long"
    for block in query_blocks(stored(rows.where("anchor").select("id", "label", "vec"), "negatives-anchors")):
        anchors = [(r["id"], r["label"], bytes(r["vec"])) for r in block]
        every = (np.array([-MOST]), np.array([MOST]))
        near = _first(table.mapInArrow(_mine(anchors, [every] * len(anchors), positives, True), KEPT_SCHEMA), positives)
        windows: list[list[tuple[int, int]]] = [[] for _ in anchors]
        told = []
        for r in sorted(near.collect(), key=lambda r: (r["anchor"], r["rank"])):  # at most ``positives`` an anchor of the block
            told.append((r["anchor"], anchors[r["anchor"]][0], len(windows[r["anchor"]]), r["id"], r["score"]))
            windows[r["anchor"]].append(_window(r["score"], low, high))
        limits = [(np.array([w[0] for w in ws], np.int64), np.array([w[1] for w in ws], np.int64)) for ws in windows]
        far = _first(table.mapInArrow(_mine(anchors, limits, negatives, False), KEPT_SCHEMA), negatives)
        far = far.join(spark.createDataFrame(told, schema), ["anchor", "win"])
        far = stored(far.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives-found")
        found = far if found is None else found.unionByName(far)
    if found is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return found
