"""Running totals, previous values and quantiles over an order that no single task holds.

A window without a partition key, or with one hot key, would put all its rows into one
task. Here the rows are range-partitioned by the order instead; each segment is handled on
its own, and what crosses from one segment to the next is a table of one row per segment
and key. The placement is written out once (``cut_lineage``), as both branches read it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.functions.draws import content_hash
from cartwheel.session import cut_lineage


def ordered_segments(df: DataFrame, order: Sequence[str], segments: int | None = None) -> DataFrame:
    """``df`` with a ``segment`` number that grows with ``order``. Runs a job.

    Rows equal in ``order`` share a segment, so make the order unique where copies abound. Unless
    their number is given, AQE cuts segments of about its advisory size, more of them for more rows.
    """
    placed = df.repartitionByRange(segments, *order) if segments else df.repartitionByRange(*order)
    return cut_lineage(placed.withColumn("segment", F.spark_partition_id()))


FEW_ROWS = 10_000           # what a task or the driver may sort at once
SEGMENT_ROWS = 1_000_000


def rows_between(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows ``start`` up to ``stop`` (from 0, the last not included) of ``df`` by ``order``, in that
    order. Runs jobs.

    Near the beginning Spark keeps the first rows of each task. Further on, rows are dealt by
    ranges of the order into segments of bounded size, and counting these tells which ones lie
    inside; only the two at the ends are numbered. Rows equal in ``order`` come by a hash of
    their content; equal rows are interchangeable, but all in one segment.
    """
    if stop <= FEW_ROWS:
        return df.orderBy(*order, content_hash(df)).offset(start).limit(max(0, stop - start))
    count = max(1, -(-df.count() // SEGMENT_ROWS))
    placed = ordered_segments(df.withColumn("_tie", content_hash(df)), [*order, "_tie"], count)
    before, whole, ends = 0, [], []
    # a row per segment of SEGMENT_ROWS rows
    for row in placed.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).orderBy("segment").collect():
        first, before = before, before + row["n"]
        if first >= start and before <= stop:
            whole.append(row["segment"])
        elif first < stop and before > start:
            ends.append((row["segment"], start - first, stop - first))
    kept = placed.filter(F.col("segment").isin(whole))
    for segment, low, high in ends:
        number = F.row_number().over(Window.partitionBy("segment").orderBy(*order, "_tie")) - 1
        kept = kept.unionByName(placed.filter(F.col("segment") == segment).withColumn("_at", number)
                                .filter((F.col("_at") >= low) & (F.col("_at") < high)).drop("_at"))
    return kept.orderBy(*order, "_tie").drop("segment", "_tie")


def running_total(df: DataFrame, order: Sequence[str], value: str, upto: str,
                  keys: Sequence[str] = (), total: str | None = None,
                  segments: int | None = None) -> DataFrame:
    """Sum of ``value`` up to and including each row, per ``keys``; and the whole sum.

    ``keys`` and ``order`` together must identify a row, and keys must not be null.
    """
    placed = ordered_segments(df, [*keys, *order], segments)
    by = [*keys, "segment"]
    # one row per key and segment; without keys at most as many rows as there are segments
    per_key = Window.partitionBy(*keys)
    carried = (placed.groupBy(*by).agg(F.sum(value).alias("_sum"))
               .withColumn("_before", F.coalesce(
                   F.sum("_sum").over(per_key.orderBy("segment")
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("_total", F.sum("_sum").over(per_key)))
    inside = (Window.partitionBy(*by).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = (placed.withColumn("_inside", F.sum(value).over(inside))
              .join(carried, by)
              .withColumn(upto, F.col("_inside") + F.col("_before")))
    if total:
        summed = summed.withColumn(total, F.col("_total"))
    return summed.drop("segment", "_sum", "_before", "_total", "_inside")


def previous_value(df: DataFrame, order: str, out: str, segments: int | None = None) -> DataFrame:
    """Value of ``order`` in the row before, over the whole frame; values must be unique."""
    placed = ordered_segments(df, [order], segments)
    last = (placed.groupBy("segment").agg(F.max(order).alias("_last"))   # a row per segment
            .withColumn("_carried", F.lag("_last").over(Window.orderBy("segment")))
            .select("segment", "_carried"))
    inside = F.lag(order).over(Window.partitionBy("segment").orderBy(order))
    return (placed.withColumn("_inside", inside)
            .join(last, "segment")
            .withColumn(out, F.coalesce("_inside", "_carried"))
            .drop("segment", "_inside", "_carried"))


def exact_quantiles(df: DataFrame, value: str, quantiles: dict[str, float],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Quantiles with linear interpolation, exact for any number of distinct values.

    Equal values are counted before anything is shuffled; ranks come from a running total.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"))
    ranked = running_total(counted, [value], "_n", "_upto", keys, total="_all")

    def at(rank):
        return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank),
                            F.col(value)))

    picks = []
    for name, q in quantiles.items():
        rank = F.lit(q) * (F.col("_all") - 1)
        picks += [at(F.floor(rank)).alias(f"_{name}_lo"), at(F.ceil(rank)).alias(f"_{name}_hi"),
                  F.max(rank - F.floor(rank)).alias(f"_{name}_part")]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(*keys, *[
        (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")).alias(n)
        for n in quantiles])
