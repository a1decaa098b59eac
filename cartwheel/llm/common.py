"""What the operators of this package share: tables, free column names, settled steps."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.session import remove_folder, scratch_folder, settle

_made: ContextVar[list[str] | None] = ContextVar("folders of settled steps", default=None)
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS_DEFAULT = "10000"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole table of the warehouse. Texts may be long, so fewer rows than Spark's default
    travel to a Python worker at once, unless the session says otherwise."""
    if spark.conf.get(ARROW_ROWS) == ARROW_ROWS_DEFAULT:
        spark.conf.set(ARROW_ROWS, "1000")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def reachable(df: DataFrame) -> DataFrame:
    """Let Python workers import this package from where the driver has it. Where executors do
    not share that folder, ship the package with ``--py-files``."""
    home = str(Path(__file__).resolve().parents[2])
    known = df.sparkSession.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return df


def map_batches(df: DataFrame, fn: Callable, schema) -> DataFrame:
    return reachable(df).mapInArrow(fn, schema)


def map_groups(df: DataFrame, keys: list[str], fn: Callable, schema) -> DataFrame:
    return reachable(df).groupBy(*keys).applyInArrow(fn, schema)


def free_names(df: DataFrame, *names: str) -> DataFrame:
    """Rename columns of ``df`` that have one of ``names`` by appending ``_in``."""
    taken = {c.lower() for c in df.columns} | {n.lower() for n in names}
    for column in df.columns:
        if column.lower() in {n.lower() for n in names}:
            new = f"{column}_in"
            while new.lower() in taken:
                new += "_in"
            taken.add(new.lower())
            df = df.withColumnRenamed(column, new)
    return df


def as_given(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names, where ``out`` has them first, renamed perhaps by
    ``free_names``, and in the same order."""
    return out.select(*[F.col(f"`{new}`").alias(old) for new, old in zip(out.columns, docs.columns)])


def settled_in(df: DataFrame, purpose: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """As ``settled``, with the folder, so that it can be removed when it has been replaced."""
    folder = scratch_folder(df.sparkSession, f"llm-{purpose}")
    if (made := _made.get()) is not None:
        made.append(folder)
    return settle(df, folder, compression), folder


def settled(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: every later step sees the same
    rows, and a lost executor costs no recomputation beyond this point."""
    return settled_in(df, purpose, compression)[0]


@contextmanager
def steps_removed(spark: SparkSession) -> Iterator[Callable[[str], None]]:
    """What steps settle meanwhile goes at the end, but for the folders that the given function is called
    with; those stay, or go with what is around."""
    outer, mine = _made.get(), []
    token = _made.set(mine)

    def keep(folder: str) -> None:
        mine.remove(folder)
        if outer is not None:
            outer.append(folder)

    try:
        yield keep
    finally:
        _made.reset(token)
        for folder in mine:
            remove_folder(spark, folder)


def settled_alone(spark: SparkSession, make: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """``settled`` of what ``make`` returns. What that settled on its way goes."""
    with steps_removed(spark) as keep:
        out, folder = settled_in(make(), purpose)
        keep(folder)
    return out


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """A settled ``df`` with a broadcast hint if its counted rows stay within ``limit`` bytes;
    beyond that Spark joins it by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def text_bytes(text: str = "text"):
    """UTF-8 bytes of a text; none for null."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def partitions_for(total: float, each: float, least: int = 1) -> int:
    return max(least, int(-(-total // each)))


def texts_of(column: pa.Array) -> list[str]:
    """Texts of one Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def batches(rows: Iterator[pa.RecordBatch], size: int, byte_size: int,
            text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` rows and about ``byte_size`` bytes of
    ``text`` (a longer text comes alone), so that work memory does not follow the longest
    batch."""
    for batch in rows:
        lengths = [len(t) if t else 0 for t in batch.column(text).to_pylist()]
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and (i - start >= size or held + n > byte_size):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)
