"""Session settings and the few places where lineage is cut on purpose."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session. Joins carry no broadcast hints. Before a
# run Spark knows of a side only the bytes of its files and the share of its columns; a sorted key
# takes twenty to a hundred times as much in the driver's memory, so only what is tiny by this estimate is
# broadcast at once. AQE broadcasts what is small by the bytes a shuffle has counted, of which the
# driver's memory takes seven times as much where keys are texts.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(512 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    # what a task reads, from files or a shuffle, is bounded; their number grows with the tables. AQE joins
    # the many small partitions it starts from up to this size
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}

# The operators read and write instants in this zone, so it is not left to the caller.
FIXED_SETTINGS = {"spark.sql.session.timeZone": "UTC"}

# Keeps per-product stream state off the heap, so that the catalog may outgrow memory.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "cartwheel", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # checkpoints go when the frames that need them are gone
    start = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for key, value in {**start, **RUNTIME_SETTINGS, **STREAM_SETTINGS, **settings, **FIXED_SETTINGS}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings it does not name itself; only UTC is imposed."""
    for key, value in FIXED_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in {**RUNTIME_SETTINGS, **STREAM_SETTINGS}.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``; a local session
    that names none uses its warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/cartwheel/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder on whatever store it is; a missing one is fine."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` out reliably, so that later branches all see the very same rows.

    Needed where a column depends on physical placement (``spark_partition_id``) or on
    ``rand``: recomputing such a column after an executor is lost could give other values.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind. Else they stay until the driver happens to
    collect its garbage, those of every step beside those of the next."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def settle(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later steps scan the columns they need, and every
    one of them sees the same rows. What was shuffled for it goes at once."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite")
    with shuffles_removed(spark):
        (writer.option("compression", compression) if compression else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
