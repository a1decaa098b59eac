"""Harmonic packing of token sequences.

A document is cut into pieces whose lengths are powers of two, the capacity at most, largest
first. A length of capacity / k belongs to class k, and every bin of class k takes exactly k pieces.
Each worker numbers its own pieces; how many pieces a class has in the workers before it tells a
worker which bins it fills, without seeing any other piece. What is left of a class goes into bins
of 2**i pieces. Every sequence is therefore full or has a power of two of ids, and none is padded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cartwheel.llm.bpe import codec
from cartwheel.llm.common import free_names, map_batches, settled

CAPACITY = 2048
END_ID = 1

_PIECES = ("doc_id long, start long, length long, doc_tokens long, ids binary, "
           "worker long, k int, place long")


@lru_cache(maxsize=64)
def _cuts(size: int, capacity: int) -> tuple[int, ...]:
    """Lengths of the pieces of the rest of a document, largest first."""
    return tuple(1 << bit for bit in range(size.bit_length() - 1, -1, -1) if size >> bit & 1)


def cut_documents(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY,
                  end_id: int = END_ID) -> DataFrame:
    """Pieces of every document: its ids by the vocabulary in the file ``tokenizer``, then
    ``end_id``. ``worker``, ``k`` and ``place`` say which task made the piece and the how-many-th
    of its class it is there. A null or empty text is the end id alone. Rows that repeat an id or a
    text are documents of their own; a null id stays null. An empty table gives no piece. Other columns are left out."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, worker = codec(tokenizer, pattern), TaskContext.get().partitionId()
        made: dict[int, int] = {}
        for batch in rows:
            out = []
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                ids = np.array([*own.encode(text or ""), end_id], dtype="<u4")
                lengths = [capacity] * (len(ids) // capacity) + list(_cuts(len(ids) % capacity, capacity))
                start = 0
                for n in lengths:
                    k = capacity // n
                    place = made.get(k, 0)
                    made[k] = place + 1
                    out.append((doc_id, start, n, len(ids), ids[start:start + n].tobytes(), worker, k, place))
                    start += n
            columns = list(zip(*out)) or [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                ["doc_id", "start", "length", "doc_tokens", "ids", "worker", "k", "place"])

    return map_batches(docs.select("doc_id", "text"), cut, _PIECES)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` (gapless from 0) and ``offset``. The pieces are settled first, so that
    numbers, counts and places belong together even if a task runs twice. Every piece is placed,
    repeated ones too; no piece gives no sequence. ``pieces`` come from ``cut_documents``, with other columns than
    the two added, or those get ``_in`` appended."""
    pieces = free_names(pieces, "sequence_id", "offset", "_n", "_base", "_rank", "_rest", "_tail")
    pieces = settled(pieces, "pieces")
    counts = pieces.groupBy("k", "worker").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("k").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    bases = settled(counts.select("k", "worker", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0))
                                  .alias("_base")), "piece-bases")
    # one row per class: as many as the capacity has halvings
    totals = {r["k"]: r["n"] for r in bases.groupBy("k").agg(F.sum("_n").alias("n")).collect()}
    full_bins, first, tails, sequence = {}, {}, {}, 0
    for k in sorted(totals):
        full, rest = divmod(totals[k], k)
        full_bins[k], first[k] = full, sequence
        sequence += full
        tails[k], at = [], 0
        for size in _cuts(rest, capacity):
            tails[k].append((at, sequence))
            at += size
            sequence += 1

    def of_class(values: dict[int, int]):
        return F.element_at(F.create_map(*[F.lit(int(x)).cast("long") for pair in values.items()
                                           for x in pair]), F.col("k").cast("long"))
    pieces = pieces.join(bases.drop("_n"), ["k", "worker"])
    rank = F.col("_base") + F.col("place")
    if not totals:
        zero = F.lit(0).cast("long")
        return pieces.select(*[c for c in pieces.columns if c != "_base"], zero.alias("sequence_id"), zero.alias("offset"))
    full = of_class(full_bins)
    rest = rank - full * F.col("k")
    ends = [F.struct(F.lit(k).alias("k"), F.lit(at).cast("long").alias("at"), F.lit(no).cast("long").alias("no"))
            for k, bins in tails.items() for at, no in bins]
    none = F.array().cast("array<struct<k:int,at:bigint,no:bigint>>")
    bin_of = F.element_at(F.filter(F.array(*ends) if ends else none,
                                   lambda b: (b["k"] == F.col("k")) & (b["at"] <= F.col("_rest"))), -1)
    return (pieces.withColumn("_rank", rank).withColumn("_rest", rest)
            .withColumn("_tail", F.when(F.col("_rest") >= 0, bin_of))
            .withColumn("sequence_id", F.coalesce(F.col("_tail")["no"],
                                                  of_class(first) + F.floor(F.col("_rank") / F.col("k"))).cast("long"))
            .withColumn("offset", F.when(F.col("_tail").isNotNull(), F.col("_rest") - F.col("_tail")["at"])
                        .otherwise(F.pmod(F.col("_rank"), F.col("k"))) * F.col("length"))
            .drop("_base", "_rank", "_rest", "_tail"))


def sequences(packed: DataFrame) -> DataFrame:
    """Ids of each sequence, in order: at most one capacity of ids meet in a group."""
    return packed.groupBy("sequence_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("offset", "ids"))), lambda p: F.hex(p["ids"])), "").alias("_hex")).select(
        "sequence_id", F.unhex("_hex").alias("ids"))


def packing_digest(docs: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """One row per piece, with a checksum for its ids; an empty table gives none, and columns besides
    ``doc_id`` and ``text`` are not looked at."""
    pieces = cut_documents(docs, tokenizer, pattern).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack_pieces(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                      "sequence_id", "offset")
