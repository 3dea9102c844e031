"""Shared Spark helpers of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    Unset in a local session (tests), a scratch folder is made for it. Unset
    on a cluster is an error: an executor's own disk is not shared.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="procura-llm-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


#: Most bytes of an Arrow batch that ``bounded_batches`` lets a session send to a Python worker.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session cuts Arrow batches at BATCH_BYTES (or at less, where it says so itself).

    Batches are counted in rows otherwise, so those of a table with long texts
    take as much memory as its texts are long, on both sides of the pipe. A
    row longer than that is a batch of its own.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    said = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(name).strip().lower())
    now = int(said[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[said[2]] if said else 0
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation. The
    folder belongs to the cluster, which clears it by age.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/procura-llm/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def least_reachable(links: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable from each linked node.

    ``links`` has two columns of one orderable type. Alternates the large-star
    and small-star steps until the forest no longer changes; each step is an
    aggregation with map-side partial minima and one join back, so the
    neighbours of a hub are never collected. Rounds grow with the logarithm of
    the longest path. Nodes without a link are not returned; null ends and
    self-links are ignored.
    """
    a, b = links.columns
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u != v").distinct()
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), tag)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        edges = stored(small, tag)
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum((F.xxhash64("u", "v") % 1000003)).alias("s")).first()
        now = (state["n"], state["x"], state["s"])
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
