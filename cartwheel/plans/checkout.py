"""Checkout of many orders as one batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.times import Instant
from cartwheel.operators import commerce as c
from cartwheel.operators.allocation import decide_by_arrival
from cartwheel.session import remove_folder, scratch_folder, settle


@dataclass(frozen=True)
class Checkout:
    """Outcome of a batch. What was sold is settled first; every output derives from it."""

    events: DataFrame      # one purchase event per unit sold
    totals: DataFrame      # lines and sum per order
    products: DataFrame    # catalog after the sale
    cart: DataFrame        # carts after the sale: refused and contested lines stay
    shortages: DataFrame   # lines that void their order
    contested: DataFrame   # orders that fit alone but not together, and were not sold
    work: str              # folder that the outputs read from

    def close(self) -> None:
        """Remove the work folder, when the outputs have been stored."""
        remove_folder(self.events.sparkSession, self.work)

    def __enter__(self) -> "Checkout":
        return self

    def __exit__(self, *error) -> None:
        self.close()


def checkout(cart: DataFrame, products: DataFrame, at: Instant, owner: str = "user_id",
             work: str | None = None, by_arrival: bool = False) -> Checkout:
    """Sell the orders that have no shortage and want no oversold product. Runs jobs.

    An order stands or falls as a whole. Which of several contenders came first is not
    guessed: their lines are returned as ``contested``. With ``by_arrival`` the time of their lines
    decides, and only those that come too late are returned.
    """
    spark = cart.sparkSession
    work = work or scratch_folder(spark, "checkout")
    # one time for all outputs, whenever they are computed
    at = at if at is not None else spark.range(1).select(F.current_timestamp()).first()[0]
    # stock and price are attached once; every verdict and output derives from these lines
    merged = c.merge_lines(cart, owner)
    lines = settle(c.with_catalog(merged, products), f"{work}/lines")
    refused = lines.filter(c.is_short()).select(owner).distinct()
    admissible = settle(lines.join(refused, owner, "left_anti"), f"{work}/admissible")
    contenders = c.wants_oversold(admissible, owner)
    uncontested = admissible.join(contenders, owner, "left_anti")
    contested = admissible.join(contenders, owner, "left_semi")
    if by_arrival:
        verdicts = decide_by_arrival(contested, products, owner, f"{work}/allocation")
        admitted = verdicts.filter("admitted").select(owner)
        uncontested = uncontested.unionByName(contested.join(admitted, owner, "left_semi"))
        contested = contested.join(admitted, owner, "left_anti")
    sold = settle(uncontested, f"{work}/sold")
    return Checkout(
        events=c.unit_events(sold, at),
        totals=c.order_totals(sold.withColumn("price", F.coalesce("price", F.lit(0.0))), owner),
        products=c.apply_stock(products, sold),
        cart=c.clear_carts(lines.select(*merged.columns), sold, owner),
        shortages=lines.filter(c.is_short()).select(
            "product_id", *[n for n in merged.columns if n != "product_id"], "stock"),
        contested=contested.select(*merged.columns), work=work)
