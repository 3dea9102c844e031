"""Session helpers.

Only tests and the bench build their own session; library code takes the
caller's session and never changes cluster-level settings.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(cores: int | str = "*", app: str = "procura", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the reports are designed for.

    AQE re-plans joins from measured shuffle sizes (broadcast conversion,
    partition coalescing, skew splitting); the static broadcast threshold is
    the size check for dimension sides.
    """
    parts = shuffle_partitions or (int(cores) * 2 if str(cores).isdigit() else 16)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .config("spark.driver.memory", "16g")
        # the reports build some thousand columns; recording the Python call site of each takes longer than analysing them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; an error if the
    session has none (an executor's own disk is not shared with the others).
    Tests and the bench set one for their session."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


#: While it is set, a write drops the shuffle files of its own plan when it ends.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back; the shuffle files of its plan go as soon as it is written."""
    spark = df.sparkSession
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


#: A join of stored sides is made in one slice of its keys per so many bytes of them, in ``MOST_SLICES`` at most
#: (each slice reads both sides once, so their number must not grow with the data).
SLICE_BYTES = 64 * 1024 * 1024
MOST_SLICES = 4


def in_slice(key: str, i: int, n: int) -> Column:
    """Rows whose key falls to slice ``i`` of ``n`` (a NULL key falls to one of them, too)."""
    return F.lit(True) if n == 1 else F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(n)) == i


class Steps:
    """Steps of a long plan, stored as Parquet in the shared folder.

    A plan that is cut so never has all its shuffles on disk at once. A lost
    executor costs a re-read, not a recomputation. ``inner`` steps lead to one
    outer step and are dropped once it is stored; what a result still reads
    belongs to the cluster, which clears the folder by age.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __call__(self, df: DataFrame, tag: str) -> DataFrame:
        self.paths.append(f"{checkpoint_dir(self.spark).rstrip('/')}/procura/{tag}-{uuid.uuid4().hex}")
        return stored(df, self.paths[-1])

    def parts(self, frames: Iterable[DataFrame], tag: str) -> DataFrame:
        """Frames of one schema, stored one after the other, as one frame."""
        paths = []
        for df in frames:
            self(df, tag)
            paths.append(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(*paths)

    def slices(self) -> int:
        """Into how many slices of its keys to cut a join of what is stored here."""
        conf, size = self.spark._jsc.hadoopConfiguration(), 0
        for path in map(self.spark._jvm.org.apache.hadoop.fs.Path, self.paths):
            size += path.getFileSystem(conf).getContentSummary(path).getLength()
        return max(1, min(MOST_SLICES, -(-size // SLICE_BYTES)))

    def inner(self) -> Steps:
        return Steps(self.spark)

    def drop(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in map(jvm.org.apache.hadoop.fs.Path, self.paths):
            path.getFileSystem(conf).delete(path, True)
        self.paths.clear()
