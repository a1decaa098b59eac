"""Funnel events synthesised from real purchases, and weighted random events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.functions.draws import below, bucket, whole
from cartwheel.functions.times import plus_minutes
from cartwheel.operators.ordering import previous_value
from cartwheel.operators.rows import number_copies
from cartwheel.schemas import CART_MINUTES, FUNNEL, RANDOM_MIX, SEED, VIEW_MINUTES

_BUCKETS = 1024
EVENT_COLUMNS = ("user_id", "event_type", "product_id", "price", "timestamp")


def cumulative_intervals(dim: DataFrame, key: str, weight: Column) -> DataFrame:
    """Each row of ``dim`` with its own interval [lo, hi) of the summed integer weights.

    Totals are taken inside hashed buckets of the unique key; only the ``_BUCKETS`` bucket
    sums are ordered in one task, whatever the size of ``dim``.
    """
    weighed = (dim.withColumn("_w", weight.cast("long")).filter(F.col("_w") > 0)
               .withColumn("_b", bucket([F.col(key)], _BUCKETS)))
    before = (weighed.groupBy("_b").agg(F.sum("_w").alias("_sum"))
              .withColumn("_before", F.sum("_sum").over(
                  Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
              .select("_b", F.coalesce("_before", F.lit(0)).alias("_before")))
    inside = F.sum("_w").over(Window.partitionBy("_b").orderBy(key)
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (weighed.withColumn("_inside", inside).join(before, "_b")
            .withColumn("hi", F.col("_before") + F.col("_inside"))
            .withColumn("lo", F.col("hi") - F.col("_w"))
            .drop("_b", "_w", "_inside", "_before"))


def weighted_pick(rows: DataFrame, row_key: Sequence[str], dim: DataFrame, key: str,
                  weight: Column, purpose: str, seed: int = SEED) -> DataFrame:
    """Each row with one row of ``dim``, drawn with probability in proportion to ``weight``.

    The weight axis is cut into as many cells as ``dim`` has rows, and intervals are listed
    under each cell they touch. A draw is joined on its cell, an equi-join with two candidates
    on average; draws are uniform over cells, so a product with a third of the weight owns a
    third of the cells instead of being a hot key. So the cells of a partition fit a hash table,
    and the rows, which may be far more, are not sorted. A draw is worked out from its row again
    where it is needed, as it would be the larger part of what is shuffled.
    """
    sums = dim.agg(F.sum(F.greatest(weight.cast("long"), F.lit(0))).alias("total"),
                   F.count_if(weight > 0).alias("n"))
    total = F.coalesce(sums.select("total").scalar(), F.lit(0))
    width = F.greatest(F.coalesce(sums.select(F.ceil(F.col("total") / F.col("n"))).scalar(),
                                  F.lit(1)), F.lit(1))

    def cell(position: Column) -> Column:
        return F.floor(position / width).cast("long")

    cells = (cumulative_intervals(dim, key, weight)
             .withColumn("_cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1)))))
    at = below([F.col(c) for c in row_key], purpose, total, seed)
    return (rows.join(cells.hint("shuffle_hash"), cell(at) == F.col("_cell"))
            .filter((F.col("lo") <= at) & (at < F.col("hi")))
            .drop("_cell", "lo", "hi"))


def filler_counts(purchases: int) -> dict[str, int]:
    """Extra views and carts that bring the funnel to its ratio."""
    return {kind: max(FUNNEL[kind] * purchases - purchases, 0) for kind in ("view", "add_to_cart")}


def conversion_path(purchases: DataFrame, key: Sequence[str] | None = None,
                    seed: int = SEED) -> DataFrame:
    """View, cart and purchase event of every purchase, in one pass.

    The cart comes 1 to 14 minutes before the purchase minute, the view 5 to 59 before that.
    """
    cols = [F.col(c) for c in (key or purchases.columns)]
    minute = F.date_trunc("minute", "timestamp")
    cart = whole(cols, "cart", *CART_MINUTES, seed)
    view = cart + whole(cols, "view", *VIEW_MINUTES, seed)
    steps = F.array(
        F.struct(F.lit("view").alias("event_type"), plus_minutes(minute, -view).alias("timestamp")),
        F.struct(F.lit("add_to_cart").alias("event_type"),
                 plus_minutes(minute, -cart).alias("timestamp")),
        F.struct(F.lit("purchase").alias("event_type"), F.col("timestamp").alias("timestamp")))
    return (purchases.withColumn("step", F.explode(steps))
            .select("user_id", "step.event_type", "product_id", "price", "step.timestamp"))


def browse_slots(purchases: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """The extra events as (slot, event_type): each purchase yields its share of them.

    So their number follows from the purchases without counting these first.
    """
    share = filler_counts(1)
    kinds = F.concat(*[F.array_repeat(F.lit(kind), n) for kind, n in share.items()])
    cols = key or purchases.columns
    return (purchases.select(*cols, F.posexplode(kinds).alias("place", "event_type"))
            .select(F.xxhash64(*cols, "place").alias("slot"), "event_type"))


def browse_events(slots: DataFrame, users: DataFrame, products: DataFrame, purchases: DataFrame,
                  seed: int = SEED) -> DataFrame:
    """Random visits: any user, a product by popularity, any minute of the purchase period.

    No purchases or no users give no events. A period of length zero gives its one minute.
    """
    ends = purchases.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    start = ends.select("first").scalar()
    span = ends.select(F.timestamp_diff("MINUTE", F.col("first"), F.col("last"))).scalar()
    picked = weighted_pick(slots, ["slot"], users.select("user_id"), "user_id", F.lit(1),
                           "user", seed)
    picked = weighted_pick(picked, ["slot"],
                           products.select("product_id", "price", "total_purchase_count"),
                           "product_id", F.col("total_purchase_count"), "product", seed)
    minute = below([F.col("slot")], "minute", span, seed)
    return picked.select("user_id", "event_type", "product_id", "price",
                         plus_minutes(start, minute.cast("int")).alias("timestamp"))


def refund_events(refunds: DataFrame) -> DataFrame:
    return refunds.select("user_id", F.lit("refund").alias("event_type"), "product_id", "price",
                          "timestamp")


def synthesize_events(purchases: DataFrame, refunds: DataFrame, users: DataFrame,
                      products: DataFrame, key: Sequence[str] | None = None,
                      seed: int = SEED, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """All events, view : cart : purchase at 10 : 3 : 1 exactly, plus refunds; not sorted.

    ``key`` names columns that identify a purchase line. Without it, equal lines are numbered
    so that each makes draws of its own. With ``part`` (i, n) only the events of the i-th of n parts
    of the lines, the same ones as without; equal lines are in one part.
    """
    def mine(df: DataFrame) -> DataFrame:
        return df.filter(bucket([F.col(c) for c in df.columns], part[1]) == part[0]) if part[1] > 1 else df

    lines = mine(purchases) if key else number_copies(mine(purchases))
    made = [conversion_path(lines, key, seed),
            browse_events(browse_slots(lines, key), users, products, purchases, seed),
            refund_events(mine(refunds))]
    columns = [F.col(c) if c != "price" else F.col(c).cast("double").alias(c)
               for c in EVENT_COLUMNS]
    out = made[0].select(*columns)
    for part in made[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def random_event_mix(slots: DataFrame, users: DataFrame, products: DataFrame,
                     seed: int = SEED) -> DataFrame:
    """One random event per ``slot``: type by fixed weights, any user, a product by popularity.

    A search names no product and has no price.
    """
    typed, upto, of = None, 0, sum(RANDOM_MIX.values())
    at = below([F.col("slot")], "type", F.lit(of), seed)
    for kind, share in RANDOM_MIX.items():
        upto += share
        typed = F.when(at < upto, kind) if typed is None else typed.when(at < upto, kind)
    who = weighted_pick(slots.withColumn("event_type", typed), ["slot"],
                        users.select("user_id"), "user_id", F.lit(1), "user", seed)
    found = weighted_pick(who, ["slot"],
                          products.select("product_id", "price", "total_purchase_count"),
                          "product_id", F.col("total_purchase_count"), "product", seed)
    # searches draw a product too and drop it, which keeps this to one pass over the slots
    named = F.col("event_type") != "search"
    return found.select("slot", "user_id", "event_type",
                        F.when(named, F.col("product_id")).alias("product_id"),
                        F.when(named, F.col("price")).alias("price"))


def replay_gaps(log: DataFrame, speed: float = 60.0, longest: float = 5.0,
                column: str = "timestamp") -> DataFrame:
    """Wait before each distinct time of the log when replayed at ``speed``. Runs a job.

    Events of one instant follow each other without a wait, so they are counted instead of
    listed. Speed 0 means no waits.
    """
    instants = log.groupBy(column).agg(F.count(F.lit(1)).alias("events"))
    ordered = previous_value(instants.filter(F.col(column).isNotNull()), column, "_previous")
    seconds = (F.unix_micros(column) - F.unix_micros("_previous")) / 1e6
    wait = F.least(seconds / speed, F.lit(longest)) if speed > 0 else F.lit(0.0)
    first = F.col("_previous").isNull()
    return ordered.select(column, "events",
                          F.when(first, F.lit(0.0)).otherwise(wait).alias("wait_seconds"))
