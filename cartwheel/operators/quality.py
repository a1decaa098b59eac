"""Table constraints, checked in bulk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The constraints of each table.
NOT_NULL = {"products": ("product_id", "description", "price", "stock"),
            "users": ("user_id",), "raw_events": ("event_type", "timestamp"),
            "cart_items": ("id", "user_id", "product_id", "quantity"),
            "daily_metrics": ("metric_date",)}
UNIQUE_KEY = {"products": "product_id", "users": "user_id", "cart_items": "id", "daily_metrics": "metric_date"}
CHECKS = {"products": {"stock below 0": "stock < 0"}}
REFERENCES = {"cart_items": {"user_id": "users", "product_id": "products"}}


def check_constraints(df: DataFrame, table: str, key: str | None = None) -> DataFrame:
    """Broken constraints with the number of rows that break each; no rows if all hold.

    Row checks share one pass. The key check counts in the map tasks first, so a key with
    very many copies is no burden on one task.
    """
    key = key or UNIQUE_KEY.get(table)
    broken: dict[str, Column] = {f"{c} missing": F.col(c).isNull()
                                 for c in NOT_NULL.get(table, ()) if c in df.columns}
    for name, rule in CHECKS.get(table, {}).items():
        broken[name] = F.expr(rule)
    counts = [F.count_if(c).alias(n) for n, c in broken.items()] or [F.lit(0).alias("none")]
    found = df.agg(*counts).unpivot([], list(broken) or ["none"], "violation", "row_count")
    if key:
        copies = (df.filter(F.col(key).isNotNull()).groupBy(key)
                  .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
                  .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
                  .select(F.lit(f"{key} not unique").alias("violation"), "row_count"))
        found = found.unionByName(copies)
    return found.filter(F.col("row_count") > 0)


def broken_rows(df: DataFrame, table: str, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows that break a rule of ``table``, once per rule, with the rule in ``violation``.

    ``parents`` maps table names to the tables that foreign keys point to; a reference whose table
    is not given is not checked. A null reference is a missing value, not a broken reference.
    """
    rules = {f"{c} missing": F.col(c).isNull() for c in NOT_NULL.get(table, ()) if c in df.columns}
    rules |= {name: F.expr(rule) for name, rule in CHECKS.get(table, {}).items()}
    named = F.array(*[F.when(broken, name) for name, broken in rules.items()])
    found = df.withColumn("violation", F.explode(F.filter(named, lambda x: x.isNotNull()))) if rules else (
        df.limit(0).withColumn("violation", F.lit("")))
    for column, parent in REFERENCES.get(table, {}).items():
        if parents and parent in parents and column in df.columns:
            lost = df.filter(F.col(column).isNotNull()).join(
                parents[parent].select(F.col(UNIQUE_KEY[parent]).alias(column)), column, "left_anti")
            found = found.unionByName(lost.select(*df.columns, F.lit(f"{column} unknown").alias("violation")))
    key = UNIQUE_KEY.get(table)
    if key and key in df.columns:
        copies = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                  .filter("_n > 1").select(key))
        found = found.unionByName(df.join(copies, key, "left_semi").select(
            *df.columns, F.lit(f"{key} not unique").alias("violation")))
    return found
