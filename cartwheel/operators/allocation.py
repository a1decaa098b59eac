"""Stock for orders that fit alone but not together: first come, first served, in parallel rounds.

One after the other, each order would be admitted if what earlier orders left covers all its lines,
and refused as a whole otherwise. Two bounds say the same of many orders at once. At most, all
earlier orders that are not refused take their quantities; an order that fits even then is
admitted. At least, those admitted so far take theirs; an order that does not fit even then is
refused. The bounds meet for the earliest undecided order, so every round decides some, and as
refusals lower the one bound and admissions raise the other, the rounds are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.session import remove_folder, scratch_folder, settle

SEGMENT_ROWS = 1_000_000    # lines of a product that one task goes through in their order


def _placed(lines: DataFrame, work: str) -> DataFrame:
    """Lines by product and arrival in segments of bounded size. The order never changes, so the
    placement is settled once; only what is decided changes from round to round."""
    rows = settle(lines, f"{work}/lines")
    count = max(1, -(-rows.count() // SEGMENT_ROWS))
    return settle(rows.repartitionByRange(count, "product_id", "_arrival", "_owner")
                  .withColumn("_segment", F.spark_partition_id()), f"{work}/placed")


def _bounds(lines: DataFrame) -> DataFrame:
    """What earlier orders take of each line's product, at least and at most."""
    sure = F.when(F.col("_admitted"), F.col("quantity")).otherwise(0)
    before = Window.partitionBy("product_id").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = (lines.groupBy("product_id", "_segment").agg(F.sum(sure).alias("_a"), F.sum("quantity").alias("_b"))
               .select("product_id", "_segment", F.coalesce(F.sum("_a").over(before), F.lit(0)).alias("_sure"),
                       F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_most")))
    inside = (Window.partitionBy("product_id", "_segment").orderBy("_arrival", "_owner")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (lines.withColumns({"_in_sure": F.coalesce(F.sum(sure).over(inside), F.lit(0)),
                               "_in_most": F.coalesce(F.sum("quantity").over(inside), F.lit(0))})
            .join(carried, ["product_id", "_segment"])
            .withColumns({"_least": F.col("_sure") + F.col("_in_sure"), "_top": F.col("_most") + F.col("_in_most")}))


def decide_by_arrival(lines: DataFrame, products: DataFrame, owner: str = "user_id",
                      work: str | None = None) -> DataFrame:
    """(``owner``, ``admitted``, ``round``) for every order of ``lines``. Runs a few jobs per round.

    An order arrives with its first line (``added_at``; none counts as first of all), and among orders
    of one moment the smaller owner comes first. ``lines`` must hold one line per owner and product
    with a positive quantity (``merge_lines``). An order for a product that is not in the catalog,
    or has no known stock, is refused.
    """
    spark = lines.sparkSession
    work = work or scratch_folder(spark, "allocation")
    arrival = F.min("added_at").over(Window.partitionBy(owner))
    given = (lines.select(F.col(owner).alias("_owner"), "product_id", F.col("quantity").cast("long").alias("quantity"),
                          arrival.alias("_arrival"))
             .join(products.select("product_id", F.col("stock").cast("long").alias("_stock")), "product_id", "left")
             .withColumn("_admitted", F.lit(False)))
    undecided = _placed(given, work)
    schema = f"_owner {lines.schema[owner].dataType.simpleString()}, admitted boolean, round int"
    turn = 0
    while True:
        turn += 1
        fits = F.coalesce(F.col("_top") + F.col("quantity") <= F.col("_stock"), F.lit(False))
        fails = F.coalesce(F.col("_least") + F.col("quantity") > F.col("_stock"), F.lit(True))
        verdicts = settle(_bounds(undecided).filter(~F.col("_admitted")).groupBy("_owner")
                          .agg(F.every(fits).alias("_fits"), F.some(fails).alias("_fails"))
                          .filter("_fits or _fails").select("_owner", F.col("_fits").alias("admitted"), F.lit(turn).alias("round")),
                          f"{work}/verdicts/{turn:05d}")
        if verdicts.isEmpty():
            break
        left = (undecided.join(verdicts.select("_owner", "admitted"), "_owner", "left")
                .filter("admitted is null or admitted")
                .withColumn("_admitted", F.col("_admitted") | F.coalesce("admitted", F.lit(False))).drop("admitted"))
        # products on which all is decided have nothing to say any more
        waiting = left.groupBy("product_id").agg(F.some(~F.col("_admitted")).alias("_waits")).filter("_waits").select("product_id")
        undecided = settle(left.join(waiting, "product_id", "left_semi"), f"{work}/round/{turn:05d}")
        if turn > 1:
            remove_folder(spark, f"{work}/round/{turn - 1:05d}")
        if undecided.isEmpty():
            break
    folders = [f"{work}/verdicts/{t:05d}" for t in range(1, turn + 1)]
    return spark.read.schema(schema).parquet(*folders).withColumnRenamed("_owner", owner)
