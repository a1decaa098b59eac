"""Nearest neighbours by inner product: NN-descent builds a graph, greedy search reads it.

Vectors get one more component that makes them equally long, so that the graph of nearest
directions serves the largest inner product for any query. A first graph comes from runs of
nodes that follow one another on a random projection. Then every node introduces its neighbours,
forward and reverse, to one another, and each keeps the best it has met, until few lists change. A
query starts from the list of its own vector, and expands the best nodes it knows until none of them
is new. Both go on until that is so, for tables of any size.

Equal vectors (by 128 bits of hash) are one numbered node, so that copies do not fill the lists; the
rows that have a vector follow when it is found, the smallest keys first.

Vectors travel to the blocks of nodes that need them, once per block; lists of ids travel packed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.llm.common import broadcast_if_small, map_batches, partitions_for, reachable, settled
from cartwheel.llm.near_vectors import usable

LIST = 24             # neighbours kept for each node
REVERSE = 24          # and nodes that name it, of which so many are asked
BLOCK = 8192          # nodes that share a task
STARTS = 3            # random projections for the first graph
RUN = 8192            # nodes next to one another on a projection that meet for it
SETTLED = 0.01        # introductions end when fewer of the entries change
BEAM = 96             # candidates a query keeps
SURE = 48             # a query has ended when so many of its best are expanded
EXPAND = 48           # nodes expanded at a time
SEED = 7

_FOUND = "node long, found array<struct<s:double,n:long>>"
_NEWS = "target long, nodes array<long>, ids array<long>, scores array<double>"


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _closeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Minus the squared distances of all pairs, in double precision; the last component, which one
    long vector can make large, by its differences."""
    a, b = x[..., :-1], y[..., :-1]
    squares = (a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :]
    return 2 * (a @ np.swapaxes(b, -1, -2)) - squares - (x[..., :, None, -1] - y[..., None, :, -1]) ** 2


def _lists(nodes: np.ndarray, counts: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> dict:
    """Arrow columns: one list of (score, id) per node; counts tell where each ends."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(scores.astype(float)), pa.array(ids.astype(np.int64))], ["s", "n"])
    return {"node": pa.array(nodes.astype(np.int64)), "found": pa.ListArray.from_arrays(pa.array(ends), pairs)}


_ASKED = "target long, queries array<long>, nodes array<long>"
_ANSWER = "home long, queries array<long>, ids array<long>, scores array<double>"
_STATE = "query long, vector array<double>, found array<struct<s:double,n:long>>, done array<long>"


def _packed(target: np.ndarray, columns: dict[str, np.ndarray], name: str = "target") -> pa.Table:
    """One row per target, its columns as lists."""
    order = np.argsort(target, kind="stable")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(target[order])) + 1, [len(order)]]) if len(order) else np.zeros(1, int)
    ends = pa.array(cuts.astype(np.int32))
    return pa.table({name: pa.array(target[order][cuts[:-1]].astype(np.int64)),
                     **{c: pa.ListArray.from_arrays(ends, pa.array(x[order])) for c, x in columns.items()}})


def _cut(node: np.ndarray, s: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The best distinct entries of every node, best first, ties to the smaller id."""
    other = node != n
    node, s, n = node[other], s[other], n[other]
    order = np.lexsort((-s, n, node))
    node, s, n = node[order], s[order], n[order]
    new = np.ones(len(node), bool)   # the same id may come twice, its score by another sum
    new[1:] = (node[1:] != node[:-1]) | (n[1:] != n[:-1])
    node, s, n = node[new], s[new], n[new]
    order = np.lexsort((n, -s, node))
    node, s, n = node[order], s[order], n[order]
    top = np.arange(len(node)) - np.searchsorted(node, node) < size
    return node[top], s[top], n[top]


def _news(node: np.ndarray, s: np.ndarray, n: np.ndarray, blocks: int) -> dict:
    """Entries as one row per block of nodes they are meant for."""
    target = node % blocks
    order = np.argsort(target, kind="stable")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(target[order])) + 1, [len(order)]]) if len(order) else np.zeros(1, int)
    ends = pa.array(cuts.astype(np.int32))
    parts = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (node.astype(np.int64), n.astype(np.int64), s.astype(float))]
    return {"target": pa.array(target[order][cuts[:-1]].astype(np.int64)), "nodes": parts[0], "ids": parts[1], "scores": parts[2]}


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _merge_news(keys, held: pa.Table, news: pa.Table) -> pa.Table:
    """Lists of one block of nodes, with the entries that came for them."""
    nodes = held.column("node").to_numpy()
    lists = held.column("found").combine_chunks()
    flat = lists.flatten()
    node = np.concatenate([np.repeat(nodes, lists.value_lengths().to_numpy(zero_copy_only=False)), _flat(news, "nodes")])
    s, n = (np.concatenate([flat.field(i).to_numpy(zero_copy_only=False), _flat(news, c)])
            for i, c in ((0, "scores"), (1, "ids")))
    node, s, n = _cut(node, s, n, LIST)
    every = np.union1d(nodes, node)
    return pa.table(_lists(every, np.bincount(np.searchsorted(every, node), minlength=len(every)), s, n))


def _first_lists(blocks: int):
    """All against all inside the runs of one range of a projection."""
    def first(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in rows if b.num_rows]
        if not parts:
            return
        block = pa.Table.from_batches(parts)
        order = np.lexsort((block.column("node").to_numpy(), block.column("place").to_numpy()))
        nodes, vectors = block.column("node").to_numpy()[order], _matrix(block.column("vector"))[order]
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]]
        for run in np.array_split(np.arange(len(nodes)), -(-len(nodes) // RUN)):
            k = min(LIST, len(run) - 1)
            for start in range(0, len(run), 512):
                some = run[start:start + 512]
                scores = _closeness(vectors[some], vectors[run])
                scores[np.arange(len(some)), some - run[0]] = -np.inf
                top = np.argpartition(-scores, max(k - 1, 0), axis=1)[:, :k]
                for out, x in zip(found, (np.repeat(nodes[some], k), np.take_along_axis(scores, top, 1).ravel(), nodes[run][top].ravel())):
                    out.append(x)
        yield pa.RecordBatch.from_pydict(_news(*(np.concatenate(x) for x in found), blocks))

    return first


def _taken_in(graph: DataFrame, news: DataFrame, blocks: int) -> DataFrame:
    """The graph with the news; both meet once per block of nodes."""
    held = graph.withColumn("block", F.pmod("node", F.lit(blocks)))
    return reachable(held).groupBy("block").cogroup(news.groupBy("target")).applyInArrow(_merge_news, _FOUND)


def _first_graph(vectors: DataFrame, dims: int, nodes: int, blocks: int) -> DataFrame:
    rng = np.random.default_rng(SEED)
    found = None
    for turn in range(STARTS):
        axis = F.array(*[F.lit(float(x)) for x in rng.standard_normal(dims)])
        place = F.aggregate(F.zip_with("vector", axis, lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y)
        # the second column deals equal places over several ranges
        dealt = (vectors.select("node", "vector", place.alias("place"))
                 .repartitionByRange(blocks, "place", F.xxhash64("node", F.lit(turn))))
        lists = map_batches(dealt, _first_lists(blocks), _NEWS)
        found = lists if found is None else found.unionByName(lists)
    bare = vectors.select("node", F.array().cast("array<struct<s:double,n:bigint>>").alias("found"))
    return _taken_in(bare, found, blocks)


def _named_by(graph: DataFrame) -> DataFrame:
    """(node, who): some of the nodes that have ``node`` in their list. A node that very many name
    is thinned out in parts before its parts meet."""
    edges = graph.select(F.explode("found.n").alias("node"), F.col("node").alias("who"))
    draw = F.xxhash64("who", "node")
    part = (edges.withColumn("draw", draw).withColumn("part", F.pmod("draw", F.lit(64))))
    for keys in (["node", "part"], ["node"]):
        order = Window.partitionBy(*keys).orderBy("draw", "who")
        part = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= REVERSE)
    return part.select("node", "who")


def _asked(graph: DataFrame) -> DataFrame:
    """(node, ids): forward and reverse neighbours."""
    return (graph.select("node", F.col("found.n").alias("ids"))
            .unionByName(_named_by(graph).groupBy("node").agg(F.collect_list("who").alias("ids")))
            .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids")))


def _wanted(rows: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """Which block of nodes wants to meet which node, dealt over the blocks that hold them."""
    for batch in rows:
        ids = batch.column("ids")
        block = np.repeat(batch.column("block").to_numpy(), ids.value_lengths().to_numpy(zero_copy_only=False))
        pair = np.unique(np.stack([block, ids.flatten().to_numpy(zero_copy_only=False)]), axis=1)
        if pair.shape[1]:
            yield from _packed(pair[1] % blocks, {"queries": pair[0], "nodes": pair[1]}).to_batches()


def _hand_out(keys, asked: pa.Table, held: pa.Table) -> pa.Table:
    """The vectors of one block for every block that wants them, each once, with the worst score
    in the list of its node."""
    pair = np.unique(np.stack([_flat(asked, "queries"), _flat(asked, "nodes")]), axis=1)
    nodes = held.column("node").to_numpy()
    order = np.argsort(nodes)
    nodes, worst = nodes[order], held.column("worst").to_numpy()[order]
    x = _matrix(held.column("vector"))[order]
    out: list[list] = [[], [], [], []]
    for block in np.unique(pair[0]):
        at = np.searchsorted(nodes, pair[1, pair[0] == block])
        for column, value in zip(out, (int(block), nodes[at], worst[at], x[at].ravel())):
            column.append(value)
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], ["at", "nodes", "worst", "values"])


def _introduce(keys, people: pa.Table, vectors: pa.Table, blocks: int) -> pa.Table:
    """In one block of nodes: all neighbours of a node meet. ``vectors`` holds each of them once,
    with the worst score in its list; only what beats it is passed on."""
    if not people.num_rows or not vectors.num_rows:
        return pa.table(_news(*(np.zeros(0, np.int64),) * 3, blocks))
    nodes = _flat(vectors, "nodes")
    x = _flat(vectors, "values").reshape(len(nodes), -1)
    order = np.argsort(nodes)
    nodes, worst, x = nodes[order], _flat(vectors, "worst")[order], x[order]
    x = np.concatenate([x, np.zeros((1, x.shape[1]))])   # one more for empty places
    wide = LIST + REVERSE
    ids = people.column("ids").to_pylist()
    kept: list[np.ndarray] = []
    for start in range(0, len(ids), 256):
        part = ids[start:start + 256]
        at = np.full((len(part), wide), len(nodes), np.int64)
        for i, row in enumerate(part):
            at[i, :len(row)] = np.searchsorted(nodes, np.array(row, np.int64))[:wide]
        met = x[at]
        scores = _closeness(met, met)
        bar = np.append(worst, np.inf)[at]
        better = (scores > bar[:, :, None]) & (at != len(nodes))[:, None, :] & (at[:, :, None] != at[:, None, :])
        i, j, k = np.nonzero(better)
        kept.append(np.stack([at[i, j].astype(np.float64), at[i, k].astype(np.float64), scores[i, j, k].astype(np.float64)]))
    a, b, s = np.concatenate(kept, axis=1)
    a, b = a.astype(np.int64), b.astype(np.int64)
    a, s, b = _cut(a, s, b, LIST)
    return pa.table(_news(nodes[a], s, nodes[b], blocks))


def _round(graph: DataFrame, vectors: DataFrame, blocks: int) -> DataFrame:
    people = settled(_asked(graph).withColumn("block", F.pmod("node", F.lit(blocks))), "asked")
    worst = graph.select("node", F.when(F.size("found") < LIST, float("-inf")).otherwise(
        F.element_at("found", -1)["s"]).alias("worst"))
    held = vectors.select("node", "vector", F.pmod("node", F.lit(blocks)).alias("home")).join(worst, "node")
    asked = map_batches(people.select("block", "ids"), lambda rows: _wanted(rows, blocks), _ASKED)
    sent = (reachable(asked).groupBy("target").cogroup(held.groupBy("home"))
            .applyInArrow(_hand_out, "at long, nodes array<long>, worst array<double>, values array<double>"))
    news = (reachable(people).groupBy("block").cogroup(sent.groupBy("at"))
            .applyInArrow(lambda keys, own, others: _introduce(keys, own, others, blocks), _NEWS))
    return _taken_in(graph, news, blocks)


def build_graph(vectors: DataFrame, dims: int, nodes: int) -> DataFrame:
    """(node, found): the best neighbours of each node, with their scores. Every round betters some
    lists and spoils none, so the rounds come to an end."""
    blocks = partitions_for(nodes, BLOCK)
    graph = settled(_first_graph(vectors, dims, nodes, blocks), "graph")
    while True:
        new = settled(_round(graph, vectors, blocks), "graph")
        old = graph.select("node", F.col("found.n").alias("before"))
        fresh = new.join(old, "node").agg(F.sum(F.size(F.array_except("found.n", "before")))).first()[0] or 0
        graph = new
        if fresh <= SETTLED * nodes * LIST:
            return graph


def _next_nodes(rows: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """The best nodes of each query that it has not expanded, dealt over the blocks that hold them."""
    for batch in rows:
        who, what = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for query, nodes in zip(*(batch.column(c).to_pylist() for c in ("query", "next"))):
            who.append(np.full(len(nodes), query, np.int64))
            what.append(np.array(nodes, np.int64))
        query, node = np.concatenate(who), np.concatenate(what)
        if len(node):
            yield from _packed(node % blocks, {"queries": query, "nodes": node}).to_batches()


def _spread(keys, asked: pa.Table, around: pa.Table, blocks: int) -> pa.Table:
    """In the block that holds them: the neighbours of the nodes asked for, to be scored."""
    query, node = _flat(asked, "queries"), _flat(asked, "nodes")
    nodes = around.column("node").to_numpy()
    order = np.argsort(nodes)
    ids = around.column("ids").combine_chunks()
    flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
    at = order[np.searchsorted(nodes[order], node)]
    counts = ends[at + 1] - ends[at]
    place = np.repeat(ends[at] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    pair = np.unique(np.stack([np.repeat(query, counts), flat[place]]), axis=1)
    return _packed(pair[1] % blocks, {"queries": pair[0], "nodes": pair[1]})


def _score(keys, asked: pa.Table, held: pa.Table, blocks: int) -> pa.Table:
    """Inner products of queries with the vectors of one block, the best of each query. The
    vectors of the queries come along with the block."""
    vectors = held.filter(pa.compute.invert(held.column("guest")))
    nodes = vectors.column("node").to_numpy()
    order = np.argsort(nodes)
    nodes, x = nodes[order], _matrix(vectors.column("vector"))[order]
    guests = held.filter(held.column("guest"))
    names = guests.column("node").to_numpy()
    by_name = np.argsort(names)
    names, y = names[by_name], _matrix(guests.column("vector"))[by_name]
    pair = np.unique(np.stack([_flat(asked, "queries"), _flat(asked, "nodes")]), axis=1)
    scores = np.empty(pair.shape[1])
    for low in range(0, pair.shape[1], 1 << 16):
        some = slice(low, low + (1 << 16))
        scores[some] = np.einsum("ij,ij->i", y[np.searchsorted(names, pair[0, some])][:, :-1],
                                 x[np.searchsorted(nodes, pair[1, some])][:, :-1])
    query, s, n = _cut(pair[0], scores, pair[1], BEAM)
    return _packed(query % blocks, {"queries": query, "ids": n, "scores": s}, "home")


def _learn(keys, state: pa.Table, answers: pa.Table) -> pa.Table:
    """Queries of one block with the candidates that came back for them."""
    queries = state.column("query").to_numpy()
    order = np.argsort(queries)
    state, queries = state.take(pa.array(order)), queries[order]
    lists = state.column("found").combine_chunks()
    flat = lists.flatten()
    query = np.concatenate([np.repeat(queries, lists.value_lengths().to_numpy(zero_copy_only=False)), _flat(answers, "queries")])
    s, n = (np.concatenate([flat.field(i).to_numpy(zero_copy_only=False), _flat(answers, c)])
            for i, c in ((0, "scores"), (1, "ids")))
    query, s, n = _cut(query, s, n, BEAM)
    found = _lists(queries, np.bincount(np.searchsorted(queries, query), minlength=len(queries)), s, n)["found"]
    return pa.table({"query": state.column("query"), "vector": state.column("vector"), "found": found, "done": state.column("done")})


def search(queries: DataFrame, graph: DataFrame, vectors: DataFrame, nodes: int) -> DataFrame:
    """(query, found): up to ``BEAM`` candidates of each query, best first. ``queries`` has the
    node of the query's own row and its vector. Rows between tasks are packed, one for each two
    blocks; the vectors of queries are sent to a block only if it is asked by them."""
    blocks = partitions_for(nodes, BLOCK)
    around = settled(_asked(graph).withColumn("block", F.pmod("node", F.lit(blocks))), "around")
    held = vectors.select(F.pmod("node", F.lit(blocks)).alias("at"), "node", "vector", F.lit(False).alias("guest"))
    state = queries.select("query", "vector", F.array().cast("array<struct<s:double,n:bigint>>").alias("found"),
                           F.array().cast("array<bigint>").alias("done"))
    fresh, ended = F.array("query"), None
    while True:
        state = settled(state.withColumn("next", fresh).withColumn("done", F.array_union("done", "next")), "search")
        # a query whose best are all expanded has ended, and takes no part in later rounds
        over = state.filter(F.size("next") == 0).select("query", "found")
        ended = over if ended is None else ended.unionByName(over)
        state = state.filter(F.size("next") > 0)
        if state.isEmpty():
            return ended
        asked = map_batches(state.select("query", "next"), lambda rows: _next_nodes(rows, blocks), _ASKED)
        spread = settled(reachable(asked).groupBy("target").cogroup(around.groupBy("block"))
                         .applyInArrow(lambda keys, a, b: _spread(keys, a, b, blocks), _ASKED), "spread")
        guests = (spread.select(F.col("target").alias("at"), F.explode(F.array_distinct("queries")).alias("node"))
                  .distinct().join(queries.select(F.col("query").alias("node"), "vector"), "node")
                  .select("at", "node", "vector", F.lit(True).alias("guest")))
        answers = (reachable(spread).groupBy("target").cogroup(held.unionByName(guests).groupBy("at"))
                   .applyInArrow(lambda keys, a, b: _score(keys, a, b, blocks), _ANSWER))
        own = state.drop("next").withColumn("block", F.pmod("query", F.lit(blocks)))
        state = own.groupBy("block").cogroup(answers.groupBy("home")).applyInArrow(_learn, _STATE)
        # next the best that were not expanded yet
        fresh = F.slice(F.array_except(F.transform(F.slice("found", 1, SURE), lambda e: e["n"]), "done"), 1, EXPAND)


def _first_members(members: DataFrame, size: int) -> DataFrame:
    """The ``size`` members of each vector with the smallest keys. A vector that very many rows have is
    thinned out in parts before its parts meet."""
    part = members.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(64)))
    for keys in (["name", "part"], ["name"]):
        order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("key"), "row")
        part = part.withColumn("order", F.row_number().over(order)).filter(F.col("order") <= size)
    return part


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each query row by inner product: query_id, rank, vec_id, score.

    Every row but the query's own is a candidate, also one with the same key. Vectors that are
    null, empty, zero, or hold null or non-finite components take no part, as query or candidate.
    Vectors of another number of components are searched among themselves. Fewer than ``k``
    candidates give fewer rows, an empty table none. Ties go to the smaller key; a null key is the
    largest.
    """
    rows = settled(vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"),
                                  F.coalesce(is_query, F.lit(False)).alias("asks"))
                   .filter(usable("vector")).withColumn("row", F.monotonically_increasing_id()), "nearest-rows")
    found = rows.filter("false").select(F.col("key").alias("query_id"), F.lit(0).alias("rank"),
                                        F.col("key").alias("vec_id"), F.lit(0.0).alias("score"))
    for width in rows.groupBy(F.size("vector").alias("n")).agg(F.max("asks").alias("asked")).filter("asked").orderBy("n").collect():
        found = found.unionByName(_nearest_of(rows.filter(F.size("vector") == width["n"]), width["n"], k))
    return found


def _nearest_of(rows: DataFrame, dims: int, k: int) -> DataFrame:
    """``nearest`` among usable rows of ``dims`` components: (row, key, vector, asks)."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    longest = rows.agg(F.max(square)).first()[0]
    # what the component lacks to the longest vector: distances are the same, and no digits are lost
    rest = square / (F.lit(longest ** 0.5) + F.sqrt(F.greatest(F.lit(longest) - square, F.lit(0.0))))
    # a node of the graph is a vector; the rows that have it are its members
    plain = F.transform("vector", lambda x: x + F.lit(0.0))    # -0.0 is 0.0
    name = F.struct(F.xxhash64(plain).alias("one"), F.xxhash64(F.lit(1), plain).alias("two"))
    members = settled(rows.select(name.alias("name"), "row", "key", "asks"), "nearest-members")
    held = settled(rows.select(name.alias("name"), F.concat("vector", F.array(rest)).alias("vector"), "asks")
                   .groupBy("name").agg(F.first("vector").alias("vector"), F.max("asks").alias("asks"))
                   .withColumn("node", F.monotonically_increasing_id()), "nearest-vectors")
    names, vectors = held.select("node", "name"), held.select("node", "vector")
    nodes = held.count()
    graph = build_graph(vectors, dims + 1, nodes)
    queries = held.filter("asks").select(F.col("node").alias("query"), "vector")
    best = search(queries, graph, vectors, nodes)
    own = F.aggregate(F.slice("vector", 1, dims), F.lit(0.0), lambda s, x: s + x * x)
    near = (best.select("query", F.explode("found").alias("e")).select("query", "e.n", F.col("e.s").alias("score"))
            .unionByName(queries.select("query", F.col("query").alias("n"), own.alias("score"))))
    first = (_first_members(members, k + 1).join(names, "name").select(F.col("node").alias("n"), "key", "row"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    best = settled(near.join(first, "n").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
                   .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "key", "row", "score"))).alias("found"))
                   .join(names.withColumnRenamed("node", "query"), "query").select("name", "found"), "nearest-found")
    # the row that asks is one of the candidates of its vector, or they are more than enough
    asking = members.filter("asks").select("name", F.col("row").alias("me"), F.col("key").alias("query_id"))
    return (asking.join(broadcast_if_small(best, 48 * (k + 1)), "name")
            .select("query_id", F.posexplode(F.slice(F.filter("found", lambda e: e["row"] != F.col("me")), 1, k)).alias("at", "e"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("e.key").alias("vec_id"), F.col("e.score").alias("score")))
