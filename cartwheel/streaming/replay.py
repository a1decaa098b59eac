"""Replay of an event log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.sinks.files import write_time_ordered


def lay_out_replay(log: DataFrame, path: str, files: int, limit: int | None = None,
                   column: str = "timestamp") -> None:
    """Write the log as files that follow each other in time, and date them in that order.

    The file source takes files by modification time. They are written in parallel, so their
    times are set afterwards, by file name, which follows the range partitions. That needs a
    file system on which times can be set, as HDFS or a local disk.
    """
    spark = log.sparkSession
    write_time_ordered(log.orderBy(column).limit(limit) if limit else log, path, files, column)
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath().getName(), s.getPath(), s.getModificationTime())
                   for s in fs.listStatus(hpath) if s.getPath().getName().startswith("part-"))
    newest = max((t for *_, t in parts), default=0)
    for place, (_, part, _) in enumerate(parts):
        fs.setTimes(part, newest - 1000 * (len(parts) - place), -1)


def replay_as_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path).withColumn("event_time", F.col("timestamp").cast("timestamp")))
