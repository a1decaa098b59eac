"""Catalog and JDBC tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cartwheel.schemas import TABLES, empty_table


def query_table(spark: SparkSession, table: str, sql: str, args: dict[str, Any] | None = None,
                schema: StructType | None = None) -> DataFrame:
    """Parameterised SQL over ``table``; an empty frame while the table does not exist yet.

    Only the missing table is forgiven: any other failure is a fault and is raised.
    ``schema`` is that of the result, by default that of the table.
    """
    if spark.catalog.tableExists(table):
        return spark.sql(sql, args=args or {})
    return empty_table(spark, schema or TABLES[table.split(".")[-1]])


def jdbc_options(url: str, table: str, user: str, password: str,
                 driver: str = "org.postgresql.Driver") -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def jdbc_split_options(column: str, lower: Any, upper: Any, partitions: int) -> dict[str, str]:
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def read_jdbc_table(spark: SparkSession, options: dict[str, str],
                    split: dict[str, str] | None = None) -> DataFrame:
    """A database table; with ``split`` each task reads one range of the split column."""
    return spark.read.format("jdbc").options(**options, **(split or {})).load()


#: How the live jobs and the daily plan lay out the folders they write.
_LAYOUT = {"raw_events": ("event_date DATE, run STRING, batch_id BIGINT", "event_date, run, batch_id"),
           "traffic_stats": ("run STRING, batch_id BIGINT", "run, batch_id")}


def ensure_tables(spark: SparkSession, database: str = "default", root: str | None = None) -> list[str]:
    """Create the result tables that are missing; existing ones are left alone.

    With ``root`` (``StreamFolders.root``) the tables that sinks write as folders are registered
    over those folders, with the partitions they have; call ``refresh_tables`` for later ones.
    """
    made = []
    if root:
        for name, (parts, columns) in _LAYOUT.items():
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/tables/{name}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
            if not spark.catalog.tableExists(f"{database}.{name}"):
                fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TABLES[name])
                spark.sql(f"CREATE TABLE {database}.{name} ({fields}, {parts}) USING parquet "
                          f"PARTITIONED BY ({columns}) LOCATION '{root}/tables/{name}'")
                made.append(name)
        refresh_tables(spark, database)
    for name, schema in TABLES.items():
        if spark.catalog.tableExists(f"{database}.{name}"):
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        layout = "PARTITIONED BY (metric_date)" if name == "daily_metrics" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {layout}")
        made.append(name)
    return made


def refresh_tables(spark: SparkSession, database: str = "default") -> None:
    """Let the catalog see the partitions that were written since."""
    for name in _LAYOUT:
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.catalog.recoverPartitions(f"{database}.{name}")
