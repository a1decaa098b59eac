"""Tables that are upserted slot by slot.

A key belongs to one of ``slots`` slots by its hash, and a slot is a folder of the table. An upsert
reads and rewrites the slots that arrivals fall into and no others. Inside, the table is bucketed and
sorted by key, so the held side of the join is read as it lies and only the arrivals move.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartwheel.session import remove_folder, scratch_folder, settle


@dataclass(frozen=True)
class KeyedTable:
    """A catalog table of rows with a unique, non-null ``key``. One writer at a time; choose
    ``slots`` so that a slot holds some hundred megabytes, and keep it."""

    name: str
    key: str
    slots: int = 64
    buckets: int = 8

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.slots)).cast("int")

    def create(self, rows: DataFrame) -> None:
        """Write the whole table. Rows of a bucket go through one task, so a slot has one file for
        each bucket."""
        (rows.withColumn("_slot", self._slot()).repartition(self.buckets, self.key)
         .write.mode("overwrite").partitionBy("_slot").bucketBy(self.buckets, self.key).sortBy(self.key)
         .format("parquet").saveAsTable(self.name))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).drop("_slot")

    def merged(self, arrivals: DataFrame, upsert: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, list[int]]:
        """(new rows of the touched slots, these slots)."""
        spark = arrivals.sparkSession
        touched = sorted(r[0] for r in arrivals.select(self._slot()).distinct().collect())     # of ``slots`` numbers
        held = spark.table(self.name).filter(F.col("_slot").isin(touched)).drop("_slot")
        return upsert(held, arrivals), touched

    def upsert(self, arrivals: DataFrame, upsert: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Merge ``arrivals``, one row per key, by ``upsert(held, arrivals)``; returns the slots that
        were rewritten. What is merged is settled first, so a run that breaks off while it
        replaces slots can be repeated."""
        spark = arrivals.sparkSession
        work = scratch_folder(spark, "upsert")
        arrivals = settle(arrivals.filter(F.col(self.key).isNotNull()), f"{work}/arrivals")
        new, touched = self.merged(arrivals, upsert)
        if touched:
            columns = spark.table(self.name).columns
            new = settle(new.withColumn("_slot", self._slot()).select(*columns), f"{work}/slots")
            mode = "spark.sql.sources.partitionOverwriteMode"
            before = spark.conf.get(mode)
            spark.conf.set(mode, "dynamic")
            try:
                new.repartition(self.buckets, self.key).write.insertInto(self.name, overwrite=True)
            finally:
                spark.conf.set(mode, before)
        remove_folder(spark, work)
        return touched
