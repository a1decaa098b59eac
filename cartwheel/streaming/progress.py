"""Consumer lag from the progress reports of a running query.

Spark keeps Kafka offsets in its checkpoint and commits none to the broker, so lag as seen
by a broker-side exporter is empty. The reports hold both ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from cartwheel.schemas import METRIC_SAMPLES, empty_table

_REPORTS = StructType([StructField("report", StringType())])


class ReportStore(StreamingQueryListener):
    """Keeps every progress report of the session's streams as a JSON line below ``path``.

        store = ReportStore(spark, path)
        spark.streams.addListener(store)

    A report is a file named after its query, run and batch, so one that is given twice is kept once.
    Files lie in a folder per day, by the time of the report.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        name = f"{report.id}-{report.runId}-{report.batchId}.json"
        path = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/day={report.timestamp[:10]}/{name}")
        out = path.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray((" ".join(report.json.split("\n")) + "\n").encode()))
        finally:
            out.close()


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """``report``, the JSON of each stored report, and ``day``; empty before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return empty_table(spark, StructType([*_REPORTS.fields, StructField("day", StringType())]))
    return spark.read.text(path).select(F.col("value").alias("report"), F.col("day").cast("string").alias("day"))


def progress_samples(reports: DataFrame, column: str = "report") -> DataFrame:
    """Metric samples of what each batch read and how long it took, by query: ``streaming_input_rows``
    and ``streaming_batch_ms``. A report that cannot be read gives none."""
    schema = "id string, name string, timestamp string, numInputRows bigint, batchDuration bigint"
    report = reports.select(F.from_json(column, schema).alias("r")).select("r.*")
    values = F.create_map(F.lit("streaming_input_rows"), F.col("numInputRows").cast("double"),
                          F.lit("streaming_batch_ms"), F.col("batchDuration").cast("double"))
    return (report.select(F.try_to_timestamp("timestamp").alias("ts"), F.explode(values).alias("metric", "value"),
                          F.create_map(F.lit("query"), F.coalesce("name", "id")).alias("labels"))
            .filter("ts is not null and value is not null").select(*METRIC_SAMPLES.names))

_OFFSETS = "map<string,map<string,bigint>>"


def lag_samples(reports: DataFrame, column: str = "report") -> DataFrame:
    """Metric samples ``kafka_consumergroup_lag`` of progress reports stored as JSON, one a row
    (``StreamingQueryProgress.json``). A partition without an end offset counts from 0; a report
    that cannot be read gives no sample."""
    schema = "id string, name string, timestamp string, sources array<struct<endOffset:string,latestOffset:string>>"
    report = reports.select(F.from_json(column, schema).alias("r")).select("r.*")
    source = report.select(F.try_to_timestamp("timestamp").alias("ts"), F.coalesce("name", "id").alias("group"),
                           F.explode("sources").alias("s"))
    ends = source.select("ts", "group", F.from_json("s.endOffset", _OFFSETS).alias("done"),
                         F.explode(F.from_json("s.latestOffset", _OFFSETS)).alias("topic", "latest"))
    parts = ends.select("ts", "group", "topic", F.col("done")[F.col("topic")].alias("done"),
                        F.explode("latest").alias("partition", "offset"))
    behind = F.col("offset") - F.coalesce(F.col("done")[F.col("partition")], F.lit(0))
    return parts.select(
        "ts", F.lit("kafka_consumergroup_lag").alias("metric"),
        F.create_map(F.lit("consumergroup"), "group", F.lit("topic"), "topic",
                     F.lit("partition"), "partition").alias("labels"),
        behind.cast("double").alias("value")).select(*METRIC_SAMPLES.names)
