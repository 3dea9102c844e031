"""Extendible-hash sharding by bytes, in DataFrame operations only.

Every row has a bit string: 60 bits of a hash of its key, then 60 bits of a
hash of all its columns. A shard is a prefix of it. Starting from one shard,
only shards over the byte limit split on their next bit, so the shards follow
the data and every one fits. Rows that share a key (one key may hold a third
of all rows) split on the content bits; rows that are equal in every column
split by their number.

Defined results: a null key is a key of its own; a null or empty text has no
bytes; an empty table has no shards; a single row over the limit is a shard of
its own that exceeds it (``oversized``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procura.llm.common import stored

KEY_BITS = 60
ALL_BITS = 2 * KEY_BITS
#: Bits that one pass over the rows looks ahead of the depth that is sure to be needed.
LOOK_AHEAD = 4

_SHARD, _BITS, _SIZE = "shard", "__bits", "__size"


def _sixty(hexadecimal: Column) -> Column:
    return F.lpad(F.bin(F.conv(F.substring(hexadecimal, 1, KEY_BITS // 4), 16, 10).cast("bigint")), KEY_BITS, "0")


def _prefix(df: DataFrame, key: str, depth: int) -> Column:
    """The row's first ``depth`` bits; the content hash is computed only past the key's bits."""
    own = _sixty(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("\0")).cast("binary")))
    if depth <= KEY_BITS:
        return F.substring(own, 1, depth)
    content = F.lpad(F.bin(F.xxhash64(*[df[c] for c in df.columns]).bitwiseAND(F.lit((1 << KEY_BITS) - 1))), KEY_BITS, "0")
    return F.concat(own, F.substring(content, 1, depth - KEY_BITS))


def shard_directory(df: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """(cell, cell_depth, shard): the directory, which maps every prefix of ``cell_depth`` bits to its shard.

    One aggregation per pass counts bytes by prefix (map-side partial sums);
    a second pass reads only rows whose prefix is still over the limit.
    Ancestors' sums come from the cells, whose number follows bytes / limit.
    """
    spark = df.sparkSession
    total = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    depth, done, left = 0, None, None
    while depth < ALL_BITS:
        start = depth
        ahead = max(0, math.ceil(math.log2(total / limit))) if total > limit else 0
        depth = min(ALL_BITS, start + ahead + LOOK_AHEAD)
        rows = df.select(_prefix(df, key, depth).alias("cell"), size.cast("bigint").alias("bytes"))
        if left is not None:
            rows = rows.withColumn("parent", F.substring("cell", 1, start)).join(left, "parent", "left_semi")
        cells = stored(rows.groupBy("cell").agg(F.sum("bytes").alias("bytes")), "cells")
        ranks = cells.withColumn("d", F.explode(F.sequence(F.lit(start), F.lit(depth)))).withColumn("node", F.substring("cell", F.lit(1), F.col("d")))
        over = ranks.groupBy("node").agg(F.sum("bytes").alias("node_bytes")).where(F.col("node_bytes") > limit).select("node")
        splits = ranks.join(over, "node").groupBy("cell").agg(F.count(F.lit(1)).alias("splits"))
        mapped = cells.join(splits, "cell", "left").select("cell", "bytes", F.lit(depth).alias("cell_depth"), (F.lit(start) + F.coalesce("splits", F.lit(0))).alias("shard_depth"))
        mapped = stored(mapped, "directory")
        stuck = mapped.where(F.col("shard_depth") > depth) if depth < ALL_BITS else mapped.limit(0)
        final = mapped.join(stuck.select("cell"), "cell", "left_anti").select("cell", "cell_depth", F.substring("cell", F.lit(1), F.least("shard_depth", F.lit(depth))).alias("shard"))
        done = final if done is None else done.unionByName(final)
        worst = stuck.agg(F.max("bytes")).first()[0]
        if worst is None:
            break
        total, left = worst, stored(stuck.select(F.col("cell").alias("parent")), "pending")
    return stored(done, "directory") if done is not None else spark.createDataFrame([], "cell string, cell_depth int, shard string")


def extendible_shards(df: DataFrame, key: str, size: Column, limit: int) -> DataFrame:
    """``df`` with its ``shard`` (bits), ``shard_depth``, ``shard_bytes``, ``shard_rows`` and ``oversized``.

    Columns of those names in ``df`` are replaced. A shard of rows equal in
    every column that is over the limit is cut by row number into
    ``bits.part``; such rows are counted once a partition before they meet.
    """
    made = ["shard", "shard_depth", "shard_bytes", "shard_rows", "oversized"]
    df = df.drop(*made)
    directory = shard_directory(df, key, size, limit)
    depths = [r[0] for r in directory.select("cell_depth").distinct().collect()]  # one a pass, at most ALL_BITS / LOOK_AHEAD
    placed = None
    for depth in sorted(depths):
        here = directory.where(F.col("cell_depth") == depth).select(F.col("cell").alias(_BITS), "shard")
        part = df.withColumn(_BITS, _prefix(df, key, depth)).withColumn(_SIZE, size.cast("bigint")).join(here, _BITS).drop(_BITS)
        placed = part if placed is None else placed.unionByName(part)
    if placed is None:
        placed = df.withColumn(_SIZE, size.cast("bigint")).withColumn("shard", F.lit("")).limit(0)
    if ALL_BITS in depths:
        placed = _equal_rows(placed, limit)
    sums = placed.groupBy("shard").agg(F.sum(F.coalesce(_SIZE, F.lit(0))).cast("bigint").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    out = placed.join(sums, "shard").withColumn("shard_depth", F.length(F.substring_index("shard", ".", 1))).withColumn("oversized", F.col("shard_bytes") > limit)
    return out.select(*df.columns, *made)


def _equal_rows(placed: DataFrame, limit: int) -> DataFrame:
    full = F.length("shard") == ALL_BITS
    columns = placed.columns
    counted = placed.where(full).groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    fits = F.greatest(F.floor(F.lit(limit) / F.greatest(F.coalesce(_SIZE, F.lit(0)), F.lit(1))), F.lit(1))
    dealt = counted.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1)))
    dealt = dealt.withColumn("shard", F.concat_ws(".", "shard", F.floor(F.col("__i") / fits).cast("string"))).select(*columns)
    return placed.where(~full).unionByName(dealt)
