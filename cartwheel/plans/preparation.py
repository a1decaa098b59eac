"""Invoice lines to products, users, purchases, refunds and synthetic events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.operators.cleaning import clean_invoice_lines, split_transactions
from cartwheel.operators.dimensions import assign_stock, build_products, build_users
from cartwheel.operators.serving import by_popularity, time_ordered
from cartwheel.operators.synthesis import synthesize_events
from cartwheel.schemas import SEED
from cartwheel.session import scratch_folder, settle
from cartwheel.sinks.files import write_csv
from cartwheel.sources.files import read_invoice_lines, sample_lines

PART_PURCHASES = 8_000_000  # purchases whose draws are shuffled at a time


@dataclass(frozen=True)
class Prepared:
    products: DataFrame
    users: DataFrame
    purchases: DataFrame
    refunds: DataFrame
    events: DataFrame
    seed: int = SEED


def prepare(lines: DataFrame, work: str | None = None, seed: int = SEED) -> Prepared:
    """Cleaned lines and both dimensions are written to ``work``, each once; the rest is lazy."""
    work = work or scratch_folder(lines.sparkSession, "preparation")
    cleaned = settle(clean_invoice_lines(lines), f"{work}/cleaned")
    products = settle(assign_stock(build_products(cleaned), seed), f"{work}/products")
    users = settle(build_users(cleaned), f"{work}/users")
    purchases, refunds = split_transactions(cleaned)
    events = synthesize_events(purchases, refunds, users, products, seed=seed)
    return Prepared(products, users, purchases, refunds, events, seed)


def event_totals(made: Prepared, total: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``total`` of the events of each part of the purchases, all parts in one table; the caller adds them up.
    A purchase makes eleven draws that are shuffled twice, so parts are worked on one after the other, and what one
    shuffled goes before the next. Runs a job for each part; a single part stays lazy."""
    parts = -(-made.purchases.count() // PART_PURCHASES)
    if parts <= 1:
        return total(made.events)
    work = scratch_folder(made.events.sparkSession, "event-totals")
    done = [settle(total(synthesize_events(made.purchases, made.refunds, made.users, made.products, seed=made.seed,
                                           part=(i, parts))), f"{work}/{i:05d}") for i in range(parts)]
    return made.events.sparkSession.read.schema(done[0].schema).parquet(*[f"{work}/{i:05d}" for i in range(parts)])


def row_counts(made: Prepared) -> DataFrame:
    """Rows of each output, events by type, as (part, row_count)."""
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("part"),
                                                                    "row_count")

    out = made.events.groupBy(F.concat(F.lit("events: "), "event_type").alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"))
    for name in ("products", "users", "purchases", "refunds"):
        out = out.unionByName(counted(name, getattr(made, name)))
    return out


def prepare_files(spark: SparkSession, source: str, target: str, fraction: float = 1.0,
                  seed: int = SEED, exact: bool = False) -> Prepared:
    """CSV in, five CSV tables out; with ``fraction`` from a sample of the lines."""
    lines = sample_lines(read_invoice_lines(spark, source), fraction, seed, exact)
    made = prepare(lines, seed=seed)
    write_csv(by_popularity(made.products), f"{target}/products")
    write_csv(made.users, f"{target}/users")
    write_csv(made.purchases, f"{target}/purchases")
    write_csv(made.refunds, f"{target}/refunds")
    write_csv(time_ordered(made.events), f"{target}/events")
    return made
