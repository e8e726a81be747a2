"""Session settings, scratch folders and size-checked broadcasts."""

import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app="revlens", master="local[*]", shuffle_partitions=8, **conf):
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.appName(app)
        .master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster shares for intermediate tables."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="revlens-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by=(), below: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, or ``below`` one made there, and continue from the written table."""
    path = scratch_dir(df.sparkSession, name) if below is None else f"{below}/{name}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_dir`` named, when nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def group_for_join(df: DataFrame, key: Column):
    """Group by a key that a table with hot keys will be joined on.

    Adaptive execution splits a hot key only if both sides are shuffled for the
    join itself.  A side grouped by just that key would not be, so it is
    grouped by the key's hash as well, which leaves the groups as they are.
    """
    return df.groupBy(F.xxhash64(key).alias("key_hash"), key)


def in_parallel(spark: SparkSession, *jobs) -> list:
    """Run independent jobs side by side, so that short ones fill idle executors."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [running.result() for running in [pool.submit(inherit(job)) for job in jobs]]


def broadcast_if_small(df: DataFrame, rows=BROADCAST_ROWS, size=BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when both the row count and the bytes are proven small.

    The check reads at most ``rows + 1`` rows.  A larger side is returned as it
    is, so that the join shuffles and adaptive execution splits skewed keys.
    """
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, total = (
        df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    )
    return F.broadcast(df) if n <= rows and total <= size else df
