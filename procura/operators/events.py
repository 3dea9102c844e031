"""Event-history aggregates (decorrelated scalar subqueries).

All reduce a hot object id before the shuffle: ``groupBy`` aggregations to one
partial row per task, the last-action rows to each task's own last rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_event(history: DataFrame, key: str, at: str, where: Column | None = None, out: str = "first_at") -> DataFrame:
    """Earliest ``at`` per ``key`` among rows passing ``where`` (MIN)."""
    h = history.where(where) if where is not None else history
    return h.groupBy(key).agg(F.min(at).alias(out))


def last_event(history: DataFrame, key: str, at: str, where: Column | None = None, out: str = "last_at") -> DataFrame:
    """Latest ``at`` per ``key`` among rows passing ``where`` (MAX)."""
    h = history.where(where) if where is not None else history
    return h.groupBy(key).agg(F.max(at).alias(out))


def max_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """MAX(value) per key (e.g. the archived amount limit per document number)."""
    return df.groupBy(key).agg(F.max(value).alias(out))


def last_action_rows(history: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows whose ``seq`` equals the maximum ``seq`` of their ``key``.

    The maximum is taken over **all** rows of the key (every object type that
    shares the id); callers filter by type afterwards. Ties are all kept; rows
    without a key or a ``seq`` never match. Written as a filter on a rank, so
    the history is scanned and shuffled once: before the shuffle each task
    keeps only the rows that are last among its own, and a hot key is reduced
    to its ties there.
    """
    last = Window.partitionBy(key).orderBy(F.col(seq).desc())
    known = history.where(F.col(key).isNotNull() & F.col(seq).isNotNull())
    return known.withColumn("__rank", F.rank().over(last)).where("__rank = 1").drop("__rank")


def child_sum(children: DataFrame, parent: str, qty: str, where: Column | None = None, out: str = "child_qty") -> DataFrame:
    """SUM(qty) of child rows per parent id (NULL → 0 is the caller's coalesce)."""
    c = children.where(where) if where is not None else children
    return c.where(F.col(parent).isNotNull()).groupBy(parent).agg(F.sum(qty).alias(out))
