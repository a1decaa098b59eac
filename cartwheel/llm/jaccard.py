"""Exact Jaccard self-join of shingle sets with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent. Two sets with similarity t or more share at least
``l`` of the first ``n - ceil(t n) + l`` shingles of either, for every ``l``. Each document picks its own
``l``: a longer prefix costs more to look through, but more matches are asked for before a pair is
verified; it takes the ``l`` for which the estimate of both together, from the frequencies of its
prefix, is least. A pair is bound by the smaller ``l`` of the two.

1. Texts with the same set are one class, told apart by a 128-bit signature.
2. Very frequent shingles (at least one document in ``HOT``) are found first, from counts made in the
   tasks; there are at most HOT x (mean set size) of them. All others are dealt into buckets by
   hash, packed, and counted there.
3. A shingle of one class matches nothing, it only takes a place in the prefix. So documents get
   back just their shared shingles, and those with fewer than ceil(t n) of them are done.
4. The rest meet on their prefixes, each pair on its first common shingle only; crowded shingles
   are split into blocks that meet two by two. A bitmap of each set bounds what two sets differ in
   from below; pairs that may pass are verified on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from cartwheel.llm.common import as_given, batches, free_names, map_batches, map_groups, partitions_for, settled
from cartwheel.llm.components import components
from cartwheel.llm.shingles import _BASE, shingle_sets, signature

HOT = 1000            # a shingle is very frequent if one document in so many has it
FLUSH = 1 << 20       # shingles that a task packs at a time, and about as many per bucket
LEVELS = 4            # largest number of matches asked for
VERIFY = 0.05         # cost of verifying a pair, per shingle, in posting look-ups
BLOCK = 1024          # documents of one shingle that meet in one task

_SIG = np.dtype("V16")


def least_overlap(n, percent: int):
    """Shingles that a set of ``n`` must share with any set as similar as ``percent``."""
    return -(-n * percent // 100)


# -- 1: classes ---------------------------------------------------------------------------------

def with_signatures(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Add ``n_shingles`` and ``sig`` (null for an empty set); the text is dropped."""
    kept = [f for f in docs.schema.fields if f.name != text]

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 2000, 8 << 20, text):
            counts, sigs = [], []
            for shingles in shingle_sets(batch.column(text).to_pylist(), size):
                counts.append(len(shingles))
                sigs.append(signature(shingles))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(counts, pa.int64()), pa.array(sigs, pa.binary())],
                [*(f.name for f in kept), "n_shingles", "sig"])

    return map_batches(docs, sign, StructType([*kept, StructField("n_shingles", LongType()),
                                               StructField("sig", BinaryType())]))


# -- 2: frequencies -----------------------------------------------------------------------------

def _loads(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(shingles, index of their document, signatures, set sizes) of about ``FLUSH`` shingles; a
    set that a load has already is left out."""
    sets: dict[bytes, np.ndarray] = {}
    held = 0

    def load() -> tuple[np.ndarray, ...]:
        lengths = np.array([len(s) for s in sets.values()])
        return (np.concatenate(list(sets.values())), np.repeat(np.arange(len(sets)), lengths),
                np.frombuffer(b"".join(sets), _SIG), lengths.astype(np.int32))

    for batch in rows:
        for shingles in shingle_sets(batch.column("text").to_pylist(), size):
            sig = signature(shingles)
            if sig is None or sig in sets:
                continue
            sets[sig] = shingles
            held += len(shingles)
            if held >= FLUSH or len(sets) == 1 << 16:      # documents are numbered by 16 bits
                yield load()
                sets, held = {}, 0
    if sets:
        yield load()


def _hot_shingles(texts: DataFrame, size: int, classes: int, mean: float) -> np.ndarray:
    """Very frequent shingles and their counts, at most HOT x mean of them. A shingle with a share
    of 1 / HOT of all classes has that share of some load, which then reports it."""
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shingles, _, sigs, _ in _loads(batches(rows, 2000, 8 << 20), size):
            found, n = np.unique(shingles, return_counts=True)
            often = n >= max(2, len(sigs) // HOT)
            yield pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(n[often])], ["h", "n"])

    hot = (map_batches(texts, count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= max(100, classes // HOT)).orderBy(F.desc("n"), "h")
           .limit(int(HOT * mean) + 1).collect())
    table = np.array([(r["h"], r["n"]) for r in hot], np.int64).reshape(-1, 2)
    return table[np.argsort(table[:, 0].view(np.uint64))] if len(table) else table


_DEALT = "bucket int, load long, hashes binary, owners binary, often binary, sigs binary, sizes binary"
_NAMES = [part.split()[0] for part in _DEALT.split(", ")]
_KINDS = [pa.int32(), pa.int64()] + [pa.binary()] * 5


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, _KINDS)], _NAMES)


def _six(hashes: np.ndarray) -> bytes:
    """48 bits of each hash; the bucket tells the rest of it apart."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _load_id(sigs: np.ndarray) -> int:
    """From the content, so that a task that runs again names its loads the same."""
    return int.from_bytes(hashlib.blake2b(sigs.tobytes(), digest_size=8).digest(), "little", signed=True)


def _shared(texts: DataFrame, size: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Shingles that several documents have, with their frequencies: rows for each load. A row
    with ``sigs`` names the documents of a load, the others refer to them by number. A shingle
    takes eight bytes on its way to its bucket, however many buckets there are."""
    known = texts.sparkSession.sparkContext.broadcast(hot)   # bounded, see _hot_shingles

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = known.value[:, 0].copy().view(np.uint64)
        for shingles, owner, sigs, sizes in _loads(batches(rows, 2000, 8 << 20), size):
            load, owner = _load_id(sigs), owner.astype(np.uint16)
            out = [(load % buckets, load, None, None, None, sigs.tobytes(), sizes.tobytes())]
            if len(keys):     # the frequency of these is known: they go straight to their documents
                at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
                often = keys[at] == shingles
                counts = np.minimum(known.value[at[often], 1], (1 << 32) - 1).astype(np.uint32)
                out.append((load % buckets, load, shingles[often].tobytes(), owner[often].tobytes(), counts.tobytes(), None, None))
                shingles, owner = shingles[~often], owner[~often]
            bucket = ((shingles >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[b]:cuts[b + 1]]
                out.append((int(b), load, _six(shingles[mine]), owner[mine].tobytes(), None, None, None))
            yield from _table(out).to_batches()

    def count(group: pa.Table) -> pa.Table:
        columns = {c: group.column(c).to_pylist() for c in _NAMES}
        rows = list(zip(*columns.values()))
        out = [r for r in rows if r[5] is not None or r[4] is not None]
        rows = [r for r in rows if r[5] is None and r[4] is None]
        if rows:
            hashes = [_from_six(r[2]) for r in rows]
            whole = np.concatenate(hashes)
            _, inverse, often = np.unique(whole, return_inverse=True, return_counts=True)
            often = often[inverse]
            ends = np.cumsum([0, *(len(h) for h in hashes)])
            # the bucket stands above the 48 bits, so that a shingle keeps one name everywhere
            name = np.uint64(rows[0][0] * _BASE & 0xFFFF << 48)
            for r, low, high in zip(rows, ends[:-1], ends[1:]):
                several = often[low:high] > 1
                if several.any():
                    out.append((r[0], r[1], (whole[low:high][several] | name).tobytes(),
                                np.frombuffer(r[3], np.uint16)[several].tobytes(),
                                often[low:high][several].astype(np.uint32).tobytes(), None, None))
        return _table(out)

    return map_groups(map_batches(texts, deal, _DEALT), ["bucket"], count, _DEALT)


# -- 3: prefixes --------------------------------------------------------------------------------

def choose_level(often: np.ndarray, single: int, n: int, percent: int) -> int:
    """Matches to ask for: the cheapest of 1 .. LEVELS by (posting entries to look through) plus
    (pairs that may have so many matches) x (cost to verify one)."""
    base = n - int(least_overlap(n, percent)) - single
    costs = []
    for level in range(1, LEVELS + 1):
        entries = float(often[:max(base + level, 0)].sum())
        costs.append(entries + entries / level * VERIFY * n)
    return int(np.argmin(costs)) + 1


def _prefixes(percent: int):
    fields = ["sig", "n", "level", "prefix", "base", "shared", "single", "bits"]
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.int32(), pa.binary()]

    def choose(group: pa.Table) -> pa.Table:
        rows = list(zip(*(group.column(c).to_pylist() for c in _NAMES)))
        sigs, sizes = next((np.frombuffer(r[5], _SIG), np.frombuffer(r[6], np.int32)) for r in rows if r[5] is not None)
        join = lambda i, kind: np.frombuffer(b"".join(r[i] for r in rows if r[2] is not None), kind)
        shingles, owner, often = join(2, np.uint64), join(3, np.uint16).astype(np.int64), join(4, np.uint32).astype(np.int64)
        order = np.lexsort((shingles, often, owner))
        shingles, owner, often = shingles[order], owner[order], often[order]
        cuts = np.searchsorted(owner, np.arange(len(sigs) + 1))
        out = []
        for i in np.flatnonzero(np.diff(cuts) >= least_overlap(sizes.astype(np.int64), percent)):
            own, n = slice(cuts[i], cuts[i + 1]), int(sizes[i])
            single = n - (cuts[i + 1] - cuts[i])
            level = choose_level(often[own], single, n, percent)
            base = n - int(least_overlap(n, percent)) - single     # shared shingles in the prefix at level 0
            prefix = shingles[own][:max(base + level, 0)]
            if len(prefix):
                out.append((sigs[i].tobytes(), n, level, prefix.view(np.int64), base,
                            np.sort(shingles[own]).tobytes(), single, parities(shingles[own]).tobytes()))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 8, kinds)], fields)

    return choose


def parities(shingles: np.ndarray) -> np.ndarray:
    """A bit for each residue: whether an odd number of shingles has it. About three bits per
    shingle, from 256 to 4096, always a power of two, so that halves can be folded together."""
    size = 1 << min(max((3 * len(shingles)).bit_length(), 8), 12)
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(bits: list[np.ndarray], size: int) -> np.ndarray:
    """The bitmaps of at least ``size`` words, folded to that size; zeros for the others."""
    out = np.zeros((len(bits), size), np.uint64)
    for i, b in enumerate(bits):
        while len(b) > size:
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
        if len(b) == size:
            out[i] = b
    return out


def _may_pass(i: np.ndarray, j: np.ndarray, n: np.ndarray, single: np.ndarray, bits: list[np.ndarray],
              percent: int) -> np.ndarray:
    """Whether the sets of each pair may be similar enough: they differ in all that one alone
    has, and in at least as many shared shingles as bits."""
    words = np.array([len(b) for b in bits])
    least = np.minimum(words[i], words[j])
    apart = (single[i] + single[j]).astype(np.int64)
    for size in np.unique(least):
        folded = _folded(bits, int(size))
        of_size = np.flatnonzero(least == size)
        for low in range(0, len(of_size), 1 << 14):
            at = of_size[low:low + (1 << 14)]
            apart[at] += np.bitwise_count(folded[i[at]] ^ folded[j[at]]).sum(1, dtype=np.int64)
    return apart * (100 + percent) <= (n[i] + n[j]) * (100 - percent)


# -- 4: pairs -----------------------------------------------------------------------------------

def _meet(percent: int):
    """Candidate pairs of a group: the shingles of a bucket, or two blocks of one shingle."""
    def meet(group: pa.Table) -> pa.Table:
        group = group.sort_by("token")
        token, block = group.column("token").to_numpy(), group.column("block").to_numpy()
        one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
        n, level, single = (group.column(c).to_numpy().astype(np.int64) for c in ("n", "level", "single"))
        sigs = group.column("sig").to_pylist()
        bits = [np.frombuffer(b, np.uint64) for b in group.column("bits").to_pylist()]
        words, needs = (_lists_of(group.column(c)) for c in ("words", "needs"))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(token)) + 1, [len(token)]])
        found = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            some = slice(low, high)
            i, j = (_few if high - low <= 6 else _many)(
                token[low], block[some], one, two, n[some], level[some], words[low:high], needs[low:high], percent)
            if len(i):
                good = _may_pass(i + low, j + low, n, single, bits, percent)
                found += zip(i[good] + low, j[good] + low)
        pair = [(min(sigs[x], sigs[y]), max(sigs[x], sigs[y])) for x, y in found]
        return pa.table([pa.array([p[k] for p in pair], pa.binary()) for k in (0, 1)], ["a", "b"])

    return meet


def _lists_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(ends) else []


def _few(token, block, one, two, n, level, words, needs, percent) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that have enough common words, ``token`` the first of them; for a handful of documents."""
    places = [dict(zip(w.tolist(), range(len(w)))) for w in words]
    left, right = [], []
    for j in range(len(n)):
        for i in range(j):
            if min(n[i], n[j]) * 100 < percent * max(n[i], n[j]):
                continue
            if one != two and block[i] == block[j]:
                continue
            m = min(level[i], level[j])
            common = [(places[i][w], w) for w in places[i].keys() & places[j].keys()
                      if needs[i][places[i][w]] <= m and needs[j][places[j][w]] <= m]
            if len(common) >= m and min(common)[1] == token:
                left.append(i)
                right.append(j)
    return np.array(left, np.int64), np.array(right, np.int64)


def _many(token, block, one, two, n, level, lists, needs, percent) -> tuple[np.ndarray, np.ndarray]:
    """The same for many documents, by products of incidence matrices."""
    flat, needs = np.concatenate(lists), np.concatenate(needs).astype(np.int64)
    words, places = np.unique(flat, return_inverse=True)
    lengths = np.array([len(p) for p in lists])
    row = np.repeat(np.arange(len(lists)), lengths)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.flatnonzero(flat == token)
    before = rank < rank[at][row]
    left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for low in range(0, len(left), 256):
        some = left[low:low + 256]
        fit = np.minimum(n[some][:, None], n[right]) * 100 >= percent * np.maximum(n[some][:, None], n[right])
        asked = np.minimum(level[some][:, None], level[right])
        for m in np.unique(asked[fit]):
            inside = needs <= m
            fits = fit & (asked == m) & (needs[at][some] <= m)[:, None] & (needs[at][right] <= m)
            if not fits.any():
                continue
            common = _overlaps(row[inside], places[inside], some, right, len(lists), len(words))
            early = inside & before
            first = _overlaps(row[early], places[early], some, right, len(lists), len(words)) == 0
            i, j = np.nonzero(fits & first & (common >= m))
            i, j = some[i], right[j]
            if one == two:
                i, j = i[i < j], j[i < j]
            pairs.append((i, j))
    return tuple(np.concatenate(x) for x in zip(*pairs))


def _overlaps(row: np.ndarray, word: np.ndarray, left: np.ndarray, right: np.ndarray, rows: int,
              words: int) -> np.ndarray:
    """Common words of each two rows, from the words that any two of them may share."""
    counts = np.zeros((len(left), len(right)), np.int32)
    place = np.full(rows, -1)
    place[left] = np.arange(len(left))
    other = np.full(rows, -1)
    other[right] = np.arange(len(right))
    for low in range(0, words, 4096):
        some = (word >= low) & (word < low + 4096)
        a = np.zeros((len(left), min(4096, words - low)), np.float32)
        b = np.zeros((len(right), a.shape[1]), np.float32)
        for out, index in ((a, place), (b, other)):
            mine = some & (index[row] >= 0)
            out[index[row[mine]], word[mine] - low] = 1
        counts += (a @ b.T).astype(np.int32)
    return counts


def _verify(percent: int):
    """Links among the pairs: of those of a task only a spanning forest (``n`` null) is passed on,
    which connects the same classes, and how many other documents each class is linked to."""
    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[bytes, bytes] = {}
        others: dict[bytes, int] = {}

        def find(x: bytes) -> bytes:
            up.setdefault(x, x)
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        def counts() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(others), pa.binary()), pa.nulls(len(others), pa.binary()),
                                              pa.array(list(others.values()), pa.int64())], ["a", "b", "n"])
            others.clear(), up.clear()
            return out

        for batch in rows:
            names = ("a", "b", "a_shared", "b_shared", "a_n", "b_n", "a_members", "b_members")
            edges = []
            for a, b, x, y, n, m, p, q in zip(*(batch.column(c).to_pylist() for c in names)):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                if 100 * both < percent * (n + m - both):
                    continue
                others[a], others[b] = others.get(a, 0) + q, others.get(b, 0) + p
                if find(a) != find(b):
                    up[find(a)] = find(b)
                    edges.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.binary()), pa.array([e[1] for e in edges], pa.binary()),
                                              pa.nulls(len(edges), pa.int64())], ["a", "b", "n"])
            if len(others) > 1 << 18:
                yield counts()
        yield counts()

    return verify


def links(docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among classes, as ``_verify`` passes them on. ``rows`` has the signatures."""
    members = settled(rows.filter("sig is not null").groupBy("sig").agg(
        F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("members")), "members")
    stats = members.agg(F.count("n").alias("classes"), F.sum("n").alias("total")).first()
    classes, total = stats["classes"], stats["total"] or 0
    texts = docs.select("text")
    buckets = partitions_for(total, FLUSH, 1)
    hot = _hot_shingles(texts, size, classes, total / max(classes, 1))
    shared = _shared(texts, size, buckets, hot)
    # copies that were in several loads come several times, all alike
    ready = settled(map_groups(shared, ["load"], _prefixes(percent),
                               "sig binary, n int, level int, prefix array<long>, base int, shared binary, "
                               "single int, bits binary").dropDuplicates(["sig"]), "prefixes")
    # prefix shingles that several of the documents left have: ids alone meet first, then what is
    # needed to compare moves once
    groups = partitions_for(ready.agg(F.sum(F.size("prefix"))).first()[0] or 1, 4000)
    slim = ready.select("sig", F.posexplode("prefix").alias("place", "token"))
    crowd = slim.groupBy("token").agg(F.count(F.lit(1)).alias("who")).filter("who > 1")
    useful = (slim.join(crowd, "token").groupBy("sig")
              .agg(F.array_sort(F.collect_list(F.struct("place", "token", "who"))).alias("useful")))
    needs = F.transform("useful", lambda u: F.greatest(u["place"] - F.col("base") + 1, F.lit(1)).cast("tinyint"))
    posts = (useful.join(ready.select("sig", "n", "level", "base", "single", "bits"), "sig")
             .select("sig", "n", "level", "single", "bits", F.transform("useful", lambda u: u["token"]).alias("words"),
                     needs.alias("needs"), F.explode("useful").alias("u"))
             .select("sig", "n", "level", "single", "bits", "words", "needs", "u.token", "u.who"))
    dealt = (posts.withColumn("blocks", F.ceil(F.col("who") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("token", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
                     "block", "sig", "n", "level", "single", "bits", "words", "needs",
                     # many small shingles share a task, a crowded one has groups of its own
                     F.when(F.col("blocks") > 1, F.col("token")).otherwise(F.pmod(F.xxhash64("token"), F.lit(groups))).alias("deal")))
    pairs = map_groups(dealt, ["deal", "one", "two"], _meet(percent), "a binary, b binary")
    full_sets = ready.select("sig", "n", "shared").join(members.select("sig", "members"), "sig")
    side = lambda c: full_sets.select(F.col("sig").alias(c), F.col("n").alias(f"{c}_n"), F.col("shared").alias(f"{c}_shared"),
                                      F.col("members").alias(f"{c}_members"))
    full = settled(pairs, "pairs").join(side("a"), "a").join(side("b"), "b")
    return map_batches(full, _verify(percent), "a binary, b binary, n long")


def _components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``docs`` (a ``key``, a ``text``, any others but the new names) without the text, with
    ``n_shingles``, ``sig``, ``root`` (same for a component; null for an empty set), ``n_links``."""
    rows = settled(with_signatures(docs, size), "signatures")
    found = settled(links(docs, rows, size, percent), "links")
    counted = rows.filter("sig is not null").groupBy("sig").agg(F.count(F.lit(1)).alias("members"))
    linked = found.filter("n is not null").groupBy(F.col("a").alias("sig")).agg(F.sum("n").alias("others"))
    of_class = settled(counted.join(components(found.filter("n is null")).withColumnRenamed("node", "sig"), "sig", "left")
                       .join(linked, "sig", "left")
                       .select("sig", F.coalesce("root", "sig").alias("root"),
                               (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "classes")
    # rows without a set have nothing to join; they stay out of the way of the join
    return (rows.filter("sig is not null").join(of_class, "sig").unionByName(
        rows.filter("sig is null").withColumns({"root": F.lit(None).cast("binary"), "n_links": F.lit(0).cast("long")})))


def jaccard_classes(docs: DataFrame, size: int = 3, percent: int = 90, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: its key, ``n_shingles``, ``component_id`` (smallest key reachable by
    links, itself included) and ``n_links`` (other documents linked directly).

    A document is its set of distinct runs of ``size`` lower-cased words, or of one run if it has
    fewer; a null, empty or blank text has no set and no links. Documents with equal sets are
    linked. Rows that repeat a key are documents of their own; a null key is never the smallest of
    a component. An empty table gives an empty result.
    """
    placed = settled(_components(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), size, percent), "placed")
    # settled before it is joined, so that a component with very many rows can be split
    smallest = settled(placed.filter("root is not null").groupBy("root").agg(F.min("key").alias("component_id")), "smallest")
    return (placed.filter("root is not null").join(smallest, "root")
            .select("key", "n_shingles", "component_id", "n_links")
            .unionByName(placed.filter("root is null").select(
                "key", "n_shingles", F.col("key").alias("component_id"), "n_links")).withColumnRenamed("key", key))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The row with the smallest key of every component, whole; ties go to a hash of the text, and
    of rows equal in both any one stays. Rows without a shingle all stay. A null key goes last. An
    empty table stays empty, and all columns keep their names, whatever they are."""
    given, docs = docs, free_names(docs, "_key")
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.xxhash64(text).alias("tie"))
    placed = settled(_components(docs.select(order.alias("key"), F.col(text).alias("text")), size, percent), "placed")
    first = (placed.filter("root is not null").groupBy("root").agg(F.min("key").alias("key")))
    # no two components share a key and a text, so a row knows from both whether it is the first
    marked = docs.withColumn("_key", order)
    chosen = marked.join(first.select(F.col("key").alias("_key")).distinct(), "_key", "left_semi")
    chosen = chosen.dropDuplicates(["_key"])
    bare = marked.join(placed.filter("root is null").select(F.col("key").alias("_key")).distinct(), "_key", "left_semi")
    return as_given(chosen.unionByName(bare).select(*docs.columns), given)
