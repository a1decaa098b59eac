"""Load dimension files into their tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cartwheel.operators.dimensions import upsert_products, upsert_users
from cartwheel.schemas import PRODUCTS, USERS
from cartwheel.sinks.snapshots import publish_snapshot, read_snapshot
from cartwheel.sources.files import read_products, read_users


def load_dimensions(spark: SparkSession, dataset: str, tables: str, tag: str) -> None:
    """Upsert both dimensions and publish them; loading the same ``tag`` again does nothing."""
    for name, read, upsert, schema in (("products", read_products, upsert_products, PRODUCTS),
                                       ("users", read_users, upsert_users, USERS)):
        base = f"{tables}/{name}"
        merged = upsert(read_snapshot(spark, base, schema), read(spark, f"{dataset}/{name}"))
        publish_snapshot(merged.select(*schema.names), base, tag)
