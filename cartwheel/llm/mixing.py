"""Mixing sources to target weights by pivotal dependent rounding.

A source's target says how often each of its documents is wanted: a whole number of copies and a
fraction. The fractions are settled in pairs. A pair moves words between its two documents, up for
one and down for the other, until one of them is at 0 or 1; which way is a draw that leaves both
expectations as they were. So the words a source gives never move away from its target, and of all
its documents at most one is left open at the end.

Pairs meet in chunks of bounded size, chunks send up their one open document, and these meet again
until a source has one: a reduction tree. Documents much longer than their source's mean go first;
the one they leave open is settled against all the others at once, which are then wanted a little
more or less often, so that what is left open at the very end is short. Draws are hashes of the documents themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.llm.common import broadcast_if_small, free_names, map_groups, partitions_for, settled
from cartwheel.operators.ordering import running_total

WEIGHTS = (5, 2, 1)     # of the sources in the order of their names, over and over
MOST = 3                # copies of a document, and with them of a source, at most
CHUNK = 1 << 12         # open documents of a source that meet in one task
LONG = 2                # times the mean of its source: such a document goes first
EXACT = 1e-12           # a fraction this near to 0 or 1 is there
PARTS = 64              # of the equal rows that are numbered
SEED = 1105

_OPEN = "sid long, row long, hash long, turn long, size double, p double"


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _draws(one: np.ndarray, other: np.ndarray, level: int) -> np.ndarray:
    """In [0, 1), from two hashes."""
    with np.errstate(over="ignore"):
        z = one.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + other.astype(np.uint64) + np.uint64(level)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def settle_pairs(size: np.ndarray, p: np.ndarray, names: np.ndarray) -> np.ndarray:
    """``p`` with at most one entry strictly between 0 and 1; the sum of size times p is kept.
    Neighbours pair up, and of each pair the one still open goes on to the next level."""
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    level = 0
    while len(open_) > 1:
        even = len(open_) // 2 * 2
        i, j = open_[:even:2], open_[1:even:2]
        a, b, pi, pj = size[i], size[j], p[i], p[j]
        rise, fall = np.minimum((1 - pi) * a, pj * b), np.minimum(pi * a, (1 - pj) * b)
        up = _draws(names[i], names[j], level) * (rise + fall) < fall
        moved = np.where(up, rise, -fall)
        # who sets the bound ends at exactly 0 or 1
        i_ends = np.where(up, (1 - pi) * a <= pj * b, pi * a <= (1 - pj) * b)
        p[i] = np.where(i_ends, np.where(up, 1.0, 0.0), pi + moved / a)
        p[j] = np.where(i_ends, pj - moved / b, np.where(up, 0.0, 1.0))
        for k in (i, j):
            p[k] = np.where(p[k] < EXACT, 0.0, np.where(p[k] > 1 - EXACT, 1.0, p[k]))
        open_ = open_[(p[open_] > 0) & (p[open_] < 1)]
        level += 1
    return p


def _settle_chunk(group: pa.Table) -> pa.Table:
    column = {c: group.column(c).to_numpy() for c in group.column_names}
    order = np.lexsort((column["turn"], column["hash"], -column["size"]))
    column = {c: column[c][order] for c in column}
    with np.errstate(over="ignore"):
        names = column["hash"] ^ (column["turn"] * 2 + 1)
    column["p"] = settle_pairs(column["size"], column["p"], names)
    return pa.table({c: column[c] for c in ("sid", "row", "hash", "turn", "size", "p")})


def _is_open() -> Column:
    return (F.col("p") > 0) & (F.col("p") < 1)


def reduce_tree(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decided, left): ``rows`` at 0 or 1, and those still open, at most one for each source."""
    decided = None
    while True:
        counts = settled(rows.groupBy("sid").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
        chunk = F.pmod(F.xxhash64("hash", "turn", F.lit(SEED)), F.ceil(F.col("n") / CHUNK))
        dealt = rows.join(broadcast_if_small(counts, 16), "sid").withColumn("chunk", chunk)
        met = settled(map_groups(dealt.select("sid", "chunk", "row", "hash", "turn", "size", "p"), ["sid", "chunk"],
                                 _settle_chunk, _OPEN), "mix-level")
        done, rows = met.filter(~_is_open()), met.filter(_is_open())
        decided = done if decided is None else decided.unionByName(done)
        most = rows.groupBy("sid").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return decided, rows


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) with ``sid``, ``weight`` and ``target``.

    Sources take the weights in turn by code point, null last, and share the sum of all sizes. A
    target stops at ``most`` times the source's size; what is above is shared again by weight
    among the others until none is above. Rounds read one row per source.
    """
    listed = settled(sources.withColumn("_last", F.col("source").isNull()), "mix-sources")
    count = listed.count()
    ranked = running_total(listed.withColumn("_one", F.lit(1)), ["_last", "source"], "_one", "sid",
                           segments=partitions_for(count, 100_000))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int"))
    ranked = settled(ranked.withColumn("sid", F.col("sid").cast("long") - 1).withColumn("weight", turn)
                     .select("source", "source_size", "sid", "weight"), "mix-ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > most * F.col("source_size")
        at = ranked.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, most * F.col("source_size"))), F.lit(0)),
                        F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if at[0] == held or not at[2]:
            break
        held, level = at[0], (total - at[1]) / at[2]
    share = F.least(F.col("weight") * F.lit(level), (most * F.col("source_size")).cast("double"))
    return ranked.withColumn("target", share)


def _numbered(rows: DataFrame) -> DataFrame:
    """``turn`` tells equal rows (same source and hash) apart, whatever order they came in."""
    known = settled(rows.groupBy("sid", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "mix-repeats")
    if known.isEmpty():
        return rows.withColumn("turn", F.lit(0).cast("long"))
    marked = settled(rows.join(broadcast_if_small(known, 24), ["sid", "hash"], "left"), "mix-marked")
    many = marked.filter("n is not null").withColumn("part", F.pmod("row", F.lit(PARTS)))
    inside = F.row_number().over(Window.partitionBy("sid", "hash", "part").orderBy("row")) - 1
    before = F.sum("c").over(Window.partitionBy("sid", "hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = (many.groupBy("sid", "hash", "part").agg(F.count(F.lit(1)).alias("c"))
              .withColumn("start", F.coalesce(before, F.lit(0))).drop("c"))
    many = many.withColumn("inside", inside).join(starts, ["sid", "hash", "part"])
    return (marked.filter("n is null").select(*rows.columns, F.lit(0).cast("long").alias("turn"))
            .unionByName(many.select(*rows.columns, (F.col("inside") + F.col("start")).cast("long").alias("turn"))))


def _against_the_rest(left: DataFrame, pools: DataFrame, most: int) -> DataFrame:
    """The open long document of each source against all its short ones at once: they hold
    ``mass`` words and are wanted ``level`` times, which may become anything from 0 to ``most``.
    Gives its new ``p`` and their new ``level``."""
    a, p, mass, level = (F.col(c) for c in ("size", "p", "mass", "level"))
    rise, fall = F.least((1 - p) * a, level * mass), F.least(p * a, (most - level) * mass)
    draw = F.shiftrightunsigned(F.xxhash64("hash", "turn", F.lit(SEED + 1)), 11) / F.lit(float(1 << 53))
    moved = F.when(draw * (rise + fall) < fall, rise).otherwise(-fall)
    exact = lambda c: F.when(c < EXACT, 0.0).when(c > 1 - EXACT, 1.0).otherwise(c)
    return (left.join(pools, "sid").withColumn("moved", moved)
            .withColumns({"p": exact(p + F.col("moved") / a), "level": level - F.col("moved") / mass})
            .drop("moved", "mass"))


def mix_documents(docs: DataFrame, size: str, key: str = "doc_id", source: str = "source", by: tuple = (),
                  weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``docs`` with ``n_copies``, how often the mix takes each document, and its source's
    ``source_size`` and ``target``; columns of ``docs`` with these names get ``_in`` appended.

    ``size`` names a column of whole sizes. Draws depend on key, source, size and the columns
    ``by``, and not on where rows lie, so equal rows together get the same copies on every run; tell documents
    of one key apart by naming a column of their own. All columns travel with their rows: leave out texts
    that are not needed. A null source is a source, the last one; a null key is a key; repeated
    rows are documents of their own. A size of null is 0, and a document of size 0 is taken no
    time. A source of one document gives it a whole number of times, by a draw. An empty table
    gives an empty result.
    """
    docs = free_names(docs, "n_copies", "source_size", "target", "level", "_row", "_hash", "_size", "_up", "_of",
                      "_sid", "_f", "_name", "_bound")
    base = settled(docs.withColumns({
        "_row": F.monotonically_increasing_id(), "_of": F.col(source),
        "_size": F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)),
        "_hash": F.xxhash64(F.lit(SEED), key, source, size, *by)}), "mix-documents")
    sums = settled(base.groupBy(F.col("_of").alias("source")).agg(
        F.sum("_size").cast("long").alias("source_size"), F.count_if(F.col("_size") > 0).alias("n")), "mix-sizes")
    targets = source_targets(sums.select("source", "source_size"), weights, most)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = settled(targets.join(sums.drop("source_size"), targets["source"].eqNullSafe(sums["source"])).select(
        targets["source"].alias("_name"), F.col("sid").alias("_sid"), "source_size", "target", wanted.alias("_f"),
        (LONG * F.col("source_size") / F.greatest("n", F.lit(1))).alias("_bound")), "mix-plan")
    row_bytes = 256     # a name and five numbers
    wide = base.join(broadcast_if_small(plan, row_bytes), F.col("_of").eqNullSafe(F.col("_name")))
    open_columns = [c.split()[0] for c in _OPEN.split(", ")]
    entry = [F.col("_sid").alias("sid"), F.col("_row").alias("row"), F.col("_hash").alias("hash"),
             F.col("_size").cast("double").alias("size")]
    fraction = F.col("_f") - F.floor("_f")
    numbered = settled(_numbered(
        wide.filter((F.col("_size") > 0) & (fraction > 0))
        .select(*entry, F.col("_f").alias("f"), (F.col("_size") > F.col("_bound")).alias("long"))), "mix-open")

    long = numbered.filter("long").withColumn("p", F.col("f") - F.floor("f"))
    decided, left = reduce_tree(long.select(*open_columns))
    short = numbered.filter("not long")
    pools = short.groupBy("sid").agg(F.sum("size").alias("mass"), F.first("f").alias("level"))
    shifted = settled(_against_the_rest(left, pools, most), "mix-shifted")
    levels = broadcast_if_small(shifted.select("sid", "level"), 16)
    moved = (short.join(levels, "sid", "left").withColumn("f", F.coalesce("level", "f"))
             .withColumn("p", F.col("f") - F.floor("f")).select(*open_columns))
    rest, last = reduce_tree(moved.unionByName(shifted.select(*open_columns)))
    draw = F.shiftrightunsigned(F.xxhash64("hash", "turn", F.lit(SEED + 2)), 11) / F.lit(float(1 << 53))
    last = last.withColumn("p", F.when(draw < F.col("p"), 1.0).otherwise(0.0))
    ups = (decided.unionByName(rest).unionByName(last).filter("p = 1")
           .select(F.col("row").alias("_row"), F.lit(1).alias("_up")))
    wanted = F.when(F.col("_size") > F.col("_bound"), F.col("_f")).otherwise(F.coalesce("level", "_f"))
    copies = F.when(F.col("_size") > 0, F.floor(wanted) + F.coalesce("_up", F.lit(0))).otherwise(0)
    return (wide.join(levels.withColumnRenamed("sid", "_sid"), "_sid", "left").join(ups, "_row", "left")
            .select(*docs.columns, copies.cast("int").alias("n_copies"), "source_size", "target"))


def mix_digest(docs: DataFrame) -> DataFrame:
    """Size, target and words taken of each document."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    return mix_documents(sized, "size", by=("text_hash",)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))
