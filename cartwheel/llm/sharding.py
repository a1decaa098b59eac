"""Two-pass external shuffle into shards.

First pass: a record's shard comes from its key by rendezvous hashing, and a seeded hash
scatters the records of a shard over buckets that fit in memory. Second pass: each bucket is
put in order by its draws, shuffled by Fisher-Yates (Spark's ``shuffle``) and written. The
number of buckets follows the bytes of each shard, so a hot key or a long shard only makes more
buckets. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.llm.common import free_names, settled, text_bytes
from cartwheel.session import scratch_folder

SEED = 20240
BUCKET_BYTES = 32 << 20
ROW_BYTES = 16          # counted for each record besides its text
LAW = "key"


def rendezvous(key: Column, shards: int, seed: int = SEED) -> Column:
    """Shard with the largest hash of (key, shard). One more shard can only win rows for itself."""
    tickets = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                          lambda i: F.struct(F.xxhash64(key, i, F.lit(seed)).alias("h"), i.alias("i")))
    return F.array_max(tickets)["i"]


def size_of(text: str = "text") -> Column:
    return (F.octet_length(text_bytes(text)) + ROW_BYTES).cast("long")


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = SEED,
                    bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id", text: str = "text",
                    folder: str | None = None) -> DataFrame:
    """Write ``docs`` as shuffled shards below ``folder`` and return them as read back.

    All columns stay; ``shard``, ``bucket``, ``place`` (in the bucket) and ``slot`` (in the shard,
    gapless from 0) are added, and columns of ``docs`` with these names get ``_in`` appended. A
    null key is a key like any other; a null text has no bytes; repeated rows are all kept, each
    with a slot of its own; an empty table gives an empty result. Rows keep their order over
    retries as long as ``docs`` lists its rows in a fixed order, as a scan does.
    """
    return with_slots(write_shards(docs, folder or scratch_folder(docs.sparkSession, "llm-shards"),
                                   shards, seed, bucket_bytes, key, text))


def write_shards(docs: DataFrame, folder: str, shards: int = 40, seed: int = SEED,
                 bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """The two passes: files below ``folder``, one folder per shard, read back as a frame."""
    spark = docs.sparkSession
    docs = free_names(docs, "shard", "bucket", "place", "slot", "_row", "_draw", "_records", "_record")
    placed = docs.withColumn("shard", rendezvous(F.col(key), shards, seed))
    # one number per shard: bounded by the parameter, not by the data
    sizes = placed.groupBy("shard").agg(F.sum(size_of(text)).alias("bytes")).collect()
    buckets = {r["shard"]: max(1, -(-r["bytes"] // bucket_bytes)) for r in sizes}
    if buckets:
        of_shard = F.create_map(*[F.lit(int(x)) for pair in buckets.items() for x in pair])
        count = F.element_at(of_shard, F.col("shard"))
    else:
        count = F.lit(1)
    row = F.monotonically_increasing_id()
    placed = (placed.withColumn("_row", row)
              .withColumn("bucket", F.pmod(F.xxhash64(F.col(key), "_row", F.lit(seed + 1)), count).cast("int"))
              .withColumn("_draw", F.xxhash64(F.col(key), "_row", F.lit(seed + 2))))
    tasks = min(max(2 * sum(buckets.values()), 1), 100_000)
    shuffled = (placed.repartition(tasks, "shard", "bucket")
                .sortWithinPartitions("shard", "bucket", "_draw")
                .groupBy("shard", "bucket")
                .agg(F.collect_list(F.struct(*docs.columns)).alias("_records"))
                .select("shard", "bucket",
                        F.posexplode(F.shuffle("_records", seed)).alias("place", "_record"))
                .select("shard", "bucket", "place", "_record.*"))
    (shuffled.sortWithinPartitions("shard", "bucket", "place")
     .write.mode("overwrite").partitionBy("shard").parquet(folder))
    return spark.read.schema(shuffled.schema).parquet(folder)


def with_slots(written: DataFrame, *columns: Column | str) -> DataFrame:
    """Rows of written shards with their slot. What was written is the truth: its counts per
    bucket say where each bucket starts. They are settled, so that Spark knows their size and
    need not move the records to join them; ``columns``, by default all, are computed first."""
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (written.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("_n"))
              .select("shard", "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    places = ["shard", "bucket", "place"]
    rest = [c for c in written.columns if c not in places]
    kept = written.select(*(columns or rest), *places)
    return (kept.join(settled(starts, "shard-starts"), ["shard", "bucket"])
            .select(*kept.columns, (F.col("_start") + F.col("place")).alias("slot")))


def shard_digest(docs: DataFrame, shards: int = 40, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document of the written shards: sizes, checksums, places, and the shard it
    would go to if there were one more."""
    written = write_shards(docs.select("doc_id", "text"),
                           scratch_folder(docs.sparkSession, "llm-shards"), shards,
                           bucket_bytes=bucket_bytes)
    return with_slots(
        written, "doc_id", size_of().alias("size"), F.crc32(text_bytes()).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        rendezvous(F.col("doc_id"), shards + 1).alias("grown_shard")
    ).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
