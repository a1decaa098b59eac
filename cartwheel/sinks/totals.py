"""Running totals kept up by what changes.

A stream in update mode hands over the keys that a batch changed, with their new totals. They are
written as that batch's delta; nothing else is rewritten. Readers take a base and the deltas after
it, and of each key the newest row. From time to time the base is written anew, so that the bytes of
a trigger follow the changed keys and not the size of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cartwheel.schemas import empty_table
from cartwheel.sinks.snapshots import KEEP_HOURS, complete_versions, publish_snapshot, settled_version
from cartwheel.session import remove_folder

REBASE_EVERY = 100      # batches


@dataclass(frozen=True)
class RunningTotals:
    """Totals per ``key`` of one run of a stream, below ``path``."""

    path: str
    fields: StructType
    key: str
    every: int = REBASE_EVERY

    def write(self, changed: DataFrame, batch_id: int, keep_hours: float = KEEP_HOURS) -> None:
        """Take in one batch; delivered again, it replaces what it wrote."""
        spark = changed.sparkSession
        (changed.select(*self.fields.names).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{self.path}/deltas"))
        if batch_id - self._base(spark)[0] >= self.every:
            self._rebase(spark, batch_id, keep_hours)

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest totals of each key."""
        upto, base = self._base(spark)
        return self._newest(spark, upto, base)

    def _newest(self, spark: SparkSession, upto: int, base: str | None, last: int | None = None) -> DataFrame:
        after = self._deltas(spark).filter(F.col("batch_id") > upto)
        if last is not None:
            after = after.filter(F.col("batch_id") <= last)
        if base:
            held = spark.read.schema(self.fields).parquet(base).withColumn("batch_id", F.lit(-1).cast("long"))
            after = after.unionByName(held)
        others = [n for n in self.fields.names if n != self.key]
        newest = F.max_by(F.struct(*others), "batch_id").alias("_t")
        return after.groupBy(self.key).agg(newest).select(self.key, "_t.*").select(*self.fields.names)

    def _deltas(self, spark: SparkSession) -> DataFrame:
        schema = StructType([*self.fields.fields, StructField("batch_id", LongType())])
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/deltas")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return empty_table(spark, schema)
        return spark.read.schema(schema).parquet(f"{self.path}/deltas")

    def _base(self, spark: SparkSession) -> tuple[int, str | None]:
        """(last batch it holds, folder) of the newest base."""
        known = complete_versions(spark, f"{self.path}/base")
        return (int(known[-1][0]), known[-1][1]) if known else (-1, None)

    def _rebase(self, spark: SparkSession, batch_id: int, keep_hours: float) -> None:
        upto, base = self._base(spark)
        publish_snapshot(self._newest(spark, upto, base, batch_id), f"{self.path}/base", str(batch_id), keep_hours)
        # readers stand on a base no older than this one, and need the deltas after it
        oldest = settled_version(spark, f"{self.path}/base", keep_hours)
        if oldest is None:
            return
        gone = self._deltas(spark).filter(F.col("batch_id") <= int(oldest)).select("batch_id").distinct().collect()
        for row in gone:        # as many as there are batches between two bases
            remove_folder(spark, f"{self.path}/deltas/batch_id={row['batch_id']}")
