"""Substring search that does not read the whole catalog.

Each row's text is taken apart into its groups of three letters. The posting table says which rows
have a group, in the order of the groups, so that looking up a few of them reads a few row groups of
it; another table counts the rows of each. A search takes the literal parts of its text, looks up
the rarest of their groups, intersects these rows, and compares just what is left with the text
itself. The catalog lies in blocks, and only blocks with such a row are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartwheel.functions.text import contains_ci
from cartwheel.session import remove_folder, scratch_folder, settle

SIZE = 3
RAREST = 4                  # groups whose rows are intersected
BLOCK_ROWS = 100_000        # of the catalog in a folder
POSTING_ROWS = 2_000_000    # in a file


def groups_of(text: Column) -> Column:
    """Distinct groups of three neighbouring letters, without case; none for shorter texts."""
    low = F.lower(text)
    places = F.sequence(F.lit(1), F.length(low) - (SIZE - 1))
    return F.when(F.length(low) >= SIZE, F.array_distinct(F.transform(places, lambda i: F.substring(low, i, F.lit(SIZE)))))


def literals(text: str) -> list[str]:
    """Parts of a search text between its wildcards, in lower case. A backslash makes the
    character after it a literal."""
    parts, current = [], ""
    for escape, plain in re.findall(r"\\(.)|(.)", text, flags=re.DOTALL):
        if plain in ("%", "_") and not escape:
            parts.append(current)
            current = ""
        else:
            current += escape or plain
    return [p.lower() for p in [*parts, current] if p]


@dataclass(frozen=True)
class TextIndex:
    """Index of the column ``text`` of a catalog, below the folder ``path``."""

    path: str
    text: str = "description"

    def build(self, catalog: DataFrame) -> None:
        """Write catalog and index. Rows may repeat; a null text is found by no search but the
        empty one."""
        spark = catalog.sparkSession
        rows = settle(catalog.withColumn("_row", F.monotonically_increasing_id()), f"{self.path}/work")
        blocks = max(1, -(-rows.count() // BLOCK_ROWS))
        placed = rows.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
        (placed.repartition("_block").write.mode("overwrite").partitionBy("_block").parquet(f"{self.path}/catalog"))
        found = settle(placed.select(F.explode(groups_of(F.col(self.text))).alias("gram"), "_block", "_row"),
                       f"{self.path}/work-postings")
        files = max(1, -(-found.count() // POSTING_ROWS))
        (found.repartitionByRange(files, "gram", "_block", "_row").sortWithinPartitions("gram", "_block", "_row")
         .write.mode("overwrite").parquet(f"{self.path}/postings"))
        counts = found.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"))
        (counts.repartitionByRange(max(1, files // 50), "gram").sortWithinPartitions("gram")
         .write.mode("overwrite").parquet(f"{self.path}/counts"))
        placed.limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")
        for work in ("work", "work-postings"):
            remove_folder(spark, f"{self.path}/{work}")

    def _catalog(self, spark: SparkSession) -> DataFrame:
        """The rows in blocks; an empty catalog has no file to tell its columns from."""
        schema = spark.read.parquet(f"{self.path}/schema").schema
        return spark.read.schema(schema).parquet(f"{self.path}/catalog").select(*schema.names)

    def candidates(self, spark: SparkSession, text: str) -> DataFrame | None:
        """(_block, _row) of the rows that have the rarest groups of ``text``; None if it has no
        literal of three letters, so that the index cannot tell."""
        wanted = sorted({p[i:i + SIZE] for p in literals(text) for i in range(len(p) - SIZE + 1)})
        if not wanted:
            return None
        counts = spark.read.schema("gram string, rows long").parquet(f"{self.path}/counts").filter(F.col("gram").isin(wanted))
        known = {r["gram"]: r["rows"] for r in counts.collect()}      # as many as the text has groups, at most
        postings = spark.read.schema("gram string, _block int, _row long").parquet(f"{self.path}/postings")
        if len(known) < len(wanted):
            return postings.filter(F.lit(False)).select("_block", "_row")
        rarest = sorted(wanted, key=lambda g: (known[g], g))[:RAREST]
        return (postings.filter(F.col("gram").isin(rarest)).groupBy("_block", "_row")
                .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(rarest)).select("_block", "_row"))

    def search(self, spark: SparkSession, text: str | None, work: str | None = None) -> DataFrame:
        """The rows whose text contains ``text``, as ``search_products`` finds them. Runs jobs over
        the index. A text without three letters in a row reads the whole catalog."""
        catalog = self._catalog(spark)
        matches = contains_ci(F.col(self.text), text)
        found = self.candidates(spark, text) if text else None
        if found is None:
            return catalog.filter(matches).drop("_block", "_row")
        found = settle(found, work or scratch_folder(spark, "search"))
        # one number for each block of BLOCK_ROWS rows, at most
        blocks = [r["_block"] for r in found.select("_block").distinct().collect()]
        return (catalog.filter(F.col("_block").isin(blocks)).filter(matches)
                .join(found, ["_block", "_row"], "left_semi").drop("_block", "_row"))
