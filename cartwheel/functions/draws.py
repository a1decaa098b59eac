"""Seeded draws that depend on row content alone.

``rand`` depends on how rows are spread over partitions; a hash of the row key does not,
so a draw survives repartitioning, retries and a change of cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.schemas import SEED

_BITS = 53  # what a double can hold exactly


def _hashed(key: list[Column], purpose: str, seed: int) -> Column:
    return F.xxhash64(*key, F.lit(purpose), F.lit(seed))


def content_hash(df: DataFrame) -> Column:
    """Hash of the whole row, to spread rows over tasks.

    A row number would spread copies as well, but it depends on the order in which a task
    happened to receive its rows: a repeated task could send a row elsewhere than before, and
    the row would be lost or doubled.
    """
    return F.xxhash64(*[F.col(c) for c in df.columns])


def uniform(key: list[Column], purpose: str, seed: int = SEED) -> Column:
    """Double in [0, 1)."""
    return F.shiftrightunsigned(_hashed(key, purpose, seed), 64 - _BITS) / F.lit(float(1 << _BITS))


def whole(key: list[Column], purpose: str, low: int, high: int, seed: int = SEED) -> Column:
    """Integer in [low, high)."""
    return (F.lit(low) + F.floor(uniform(key, purpose, seed) * (high - low))).cast("int")


def below(key: list[Column], purpose: str, bound: Column, seed: int = SEED) -> Column:
    """Long in [0, bound); 0 where the bound is 0."""
    return F.floor(uniform(key, purpose, seed) * bound).cast("long")


def bucket(key: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
