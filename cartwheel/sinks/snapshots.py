"""Whole-table snapshots that readers never see half written.

Each publication goes to a folder of its own. Spark leaves ``_SUCCESS`` there once the write
is committed, and readers take the newest folder that has it.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cartwheel.schemas import empty_table

KEEP_HOURS = 24.0
_NAME = re.compile(r"^version=(\d+)-(.*)$")


def _hadoop(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _versions(spark: SparkSession, base: str) -> list[tuple[int, str, str, bool]]:
    """(number, tag, path, complete), oldest first."""
    fs, root = _hadoop(spark, base)
    if not fs.exists(root):
        return []
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    found = []
    for status in fs.listStatus(root):
        match = _NAME.match(status.getPath().getName())
        if match:
            done = fs.exists(path_of(status.getPath(), "_SUCCESS"))
            found.append((int(match[1]), match[2], status.getPath().toString(), done))
    return sorted(found)


def complete_versions(spark: SparkSession, base: str) -> list[tuple[str, str]]:
    """(tag, path) of what readers may see, oldest first."""
    return [(tag, path) for _, tag, path, done in _versions(spark, base) if done]


def settled_version(spark: SparkSession, base: str, keep_hours: float) -> str | None:
    """Tag of the newest version that has been complete for ``keep_hours``: whoever reads now began
    after it was there."""
    limit = time.time() * 1000 - keep_hours * 3_600_000
    old = [tag for tag, path in complete_versions(spark, base) if _completed(spark, path) <= limit]
    return old[-1] if old else None


def publish_snapshot(df: DataFrame, base: str, tag: str, keep_hours: float = KEEP_HOURS) -> bool:
    """Publish ``df`` as the newest version of ``base``.

    ``tag`` names the publication (say run and batch id). A tag that was already published
    is left alone, so a replayed batch changes nothing. A version goes once a newer one has been
    complete for ``keep_hours``, which must be longer than the longest reader runs; their number
    does not matter. Returns whether anything was written.
    """
    spark = df.sparkSession
    known = _versions(spark, base)
    if any(t == tag and done for _, t, _, done in known):
        return False
    number = max((n for n, *_ in known), default=0) + 1
    df.write.mode("overwrite").parquet(f"{base}/version={number:012d}-{tag}")
    # one writer per base: what lies there incomplete was left by a failed attempt
    complete = [path for _, _, path, done in known if done]
    broken = [path for _, _, path, done in known if not done]
    oldest = time.time() * 1000 - keep_hours * 3_600_000
    replaced = [path for path, newer in zip(complete, complete[1:]) if _completed(spark, newer) < oldest]
    for path in broken + replaced:
        fs, old = _hadoop(spark, path)
        fs.delete(old, True)
    return True


def _completed(spark: SparkSession, path: str) -> int:
    """When a version was committed, in milliseconds."""
    fs, mark = _hadoop(spark, f"{path}/_SUCCESS")
    return fs.getFileStatus(mark).getModificationTime()


def read_snapshot(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The last complete version; an empty frame before the first one."""
    done = [path for _, _, path, ok in _versions(spark, base) if ok]
    if not done:
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(done[-1])
