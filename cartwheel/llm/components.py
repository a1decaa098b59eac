"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import settled


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; nodes of one component share a root.

    In each round every node joins the neighbour, or itself, with the smallest hash of the round;
    edges are drawn between what nodes joined, and a constant share of the nodes goes, whatever
    the shape. Nodes with very many edges are reduced by partial aggregation before the shuffle,
    and the joins are plain equi-joins that AQE splits. Every round is settled, so a lost executor
    repeats one round at most. Null ends are ignored; no edges give no rows.
    """
    edges = settled(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                    .filter("a is not null and b is not null"), "edges")
    label, turn = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hashed = [F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id")) for c in "ab"]
        joins = settled(both.groupBy("a").agg(F.min(F.least(*hashed)).alias("m"))
                        .select(F.col("a").alias("node"), F.col("m.id").alias("to")), "joins")
        if label is None:
            label = joins.select("node", F.col("to").alias("root"))
        else:
            label = settled(label.join(joins.withColumnRenamed("node", "root"), "root", "left")
                            .select("node", F.coalesce("to", "root").alias("root")), "roots")
        left = joins.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        right = joins.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        edges = settled(edges.join(left, "a").join(right, "b").filter("a_to <> b_to")
                        .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
                        .distinct(), "edges")
        if edges.isEmpty():
            return label
        turn += 1
