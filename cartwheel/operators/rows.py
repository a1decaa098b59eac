"""Repeating and numbering rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_CHUNK = 1000


def repeat_rows(df: DataFrame, times: str, index: str, spread: bool = False) -> DataFrame:
    """Each row ``times`` times, numbered from 1 in ``index``; none for 0 or null.

    Repetitions are unrolled in chunks, so a huge count needs no huge array; with ``spread``
    the chunks also move to tasks of their own.
    """
    count = F.col(times).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), count - 1, F.lit(_CHUNK).cast("long"))
    chunks = df.filter(F.col(times) > 0).withColumn("_from", F.explode(starts))
    if spread:
        chunks = chunks.repartition(F.xxhash64("_from", *df.columns))
    until = F.least(F.col("_from") + _CHUNK, count)
    return chunks.withColumn(index, F.explode(F.sequence(F.col("_from") + 1, until))).drop("_from")


def number_copies(df: DataFrame, index: str = "copy") -> DataFrame:
    """``df`` with its equal rows numbered from 1, whatever their number and placement.

    Rows with few copies, nearly all as a rule, are unrolled where they were counted; only
    the groups of very many copies are spread over the tasks.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    few = repeat_rows(counted.filter(F.col("_copies") <= _CHUNK), "_copies", index)
    many = repeat_rows(counted.filter(F.col("_copies") > _CHUNK), "_copies", index, spread=True)
    return few.unionByName(many).drop("_copies")
