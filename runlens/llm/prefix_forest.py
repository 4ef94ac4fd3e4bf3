"""Approximate nearest neighbours with a forest of hash prefixes.

Index. The vectors are dealt by a hash of their id into shards of about
``shard_rows``. A shard holds, for each of ``trees`` trees, its vectors'
long hash strings (``DEPTH`` signs of random projections) as one sorted
array: a prefix tree in which the vectors below any prefix are one slice.
The strings of a tree draw their bits from one pool of planes, so many trees
cost one projection.

Search. A query descends every tree to the longest prefix that some vector
shares with it, a length that varies by tree and query. From the longest of
these lengths on, all trees ascend together, one bit at a time, and the
vectors below the prefixes join the candidates, until enough have. The
candidates' inner products are computed exactly in double precision on the
original vectors; the ``k`` best of each shard are merged.

Inner products. To hash by angle but rank by inner product, index vectors
get one more component, sqrt(M^2 - |x|^2) with M the longest norm, and
queries a zero there: then the angle orders vectors as the inner product does.
Three things keep that component and the common part of the vectors from
swamping the hash bits. The shard's mean is subtracted, which moves all
products of a query alike. Vectors and queries are then scaled against each
other along the axes that balance their spreads, which keeps the products.
The vectors are cut by norm into bands with a forest and an M each; a band
gives candidates in proportion to its norms, since a longer vector ranks high
at a wider angle. Bands are searched from the longest norms down, and one
whose norms can't reach a query's k-th product found is left out.

Recall. How many candidates a shard has to give depends on the data. For
``SAMPLE`` of its queries the nearest of the shard are found exactly (shards
are dealt by chance, so of S shards each has about k / S of the k nearest;
twice as many are looked at), along with the share of the shard that an ascent
meets before it meets each of them. The least share, from ``share`` on, that
would have met ``RECALL`` of them is used for all queries of the shard. Where
hashes tell little, as in vectors that fill all directions alike, that is a
large share, and where they tell nothing it is the whole shard.

The set of queries grows with the table, so it is never broadcast. Queries are
dealt into blocks; a unit of work is a shard and up to ``GROUP`` blocks, for
which the forest is built once and through which the blocks are streamed, so a
task holds one shard and one block. At ``share`` = 1 the search is exact. A
shard gives more than ``k`` candidates if it has them, so no query returns
fewer than there are.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and rows without a vec_id, take no part. Rows that
share a vec_id are one vector, the smallest of theirs; a query is never its
own candidate. Vectors of another length than a query are no candidates of
it. Equal products rank by smaller vec_id. With fewer than ``k`` candidates
in all, a query returns all found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import finite_vector, matrix, stored, units

#: Bits of a hash string; random planes for each tree, of which every tree draws its bits; bits of the longest prefix
#: whose slices are tabulated.
DEPTH, POOL, TABLE = 32, 4, 14
#: Parts of the trees that ascend one bit one after the other, so that the ascent can stop between them; slices that
#: are opened at once.
TURNS, PAIRS = 4, 1 << 15
#: Shards of which the best candidates are merged at once; query blocks that one building of a shard's forest serves.
MERGE, GROUP = 64, 64
#: Longest over shortest norm of a band, and bands of a shard; the last band takes all shorter vectors.
BAND, BANDS = 1.3, 8
#: Queries of a unit that are also answered exactly, the share of their nearest that has to be among the
#: candidates, and the step by which the share of candidates grows until it is.
SAMPLE, RECALL, STEP = 64, 0.93, 0.01


class Forest:
    """The prefix trees of the vectors of one band: for each tree their hash strings as one sorted array.

    The sorted arrays of all trees lie behind each other, with the tree's number before the string, so that one search
    serves any number of pairs of tree and query. For prefixes of up to ``TABLE`` bits, where the slices get large and
    every pair asks, the bounds of all slices are kept in a table instead.
    """

    def __init__(self, vectors: np.ndarray, longest: float, trees: int, seed: int) -> None:
        self.n, self.trees = len(vectors), trees
        rng = np.random.default_rng([seed, vectors.shape[1]])
        pool = max(DEPTH, trees * POOL)
        self.planes = rng.standard_normal((vectors.shape[1] + 1, pool))
        self.chosen = np.argsort(rng.random((trees, pool)), axis=1)[:, :DEPTH]
        rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        strings = self._strings(np.column_stack([vectors, rest]))
        self.order = np.argsort(strings, axis=1).astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1).astype(np.uint64)
        self.flat = (self._tree_bits() + self.sorted).ravel()
        self.bits = min(TABLE, max(1, self.n.bit_length()))
        edges = np.arange((1 << self.bits) + 1, dtype=np.uint64) << np.uint64(DEPTH - self.bits)
        self.table = np.stack([np.searchsorted(s, edges) for s in self.sorted]).astype(np.int32)

    def _tree_bits(self) -> np.ndarray:
        return np.arange(self.trees, dtype=np.uint64)[:, None] << np.uint64(DEPTH)

    def _strings(self, x: np.ndarray) -> np.ndarray:
        """trees x vectors: hash strings as numbers, the first sign the highest bit."""
        signs = self.planes.T @ x.T > 0
        bytes_of = np.array([np.packbits(signs[c], axis=0) for c in self.chosen], np.uint32)  # trees x 4 x vectors
        return bytes_of[:, 0] << 24 | bytes_of[:, 1] << 16 | bytes_of[:, 2] << 8 | bytes_of[:, 3]

    def descend(self, strings: np.ndarray) -> np.ndarray:
        """Per tree and query the length of the longest prefix that a vector of the band shares."""
        at = np.searchsorted(self.flat, (self._tree_bits() + strings).ravel()).reshape(strings.shape)
        first = np.arange(self.trees)[:, None] * self.n
        longest = np.zeros(strings.shape, np.int64)
        for beside in (np.maximum(at - 1, first), np.minimum(at, first + self.n - 1)):
            differ = (self.flat[beside] & np.uint64((1 << DEPTH) - 1)) ^ strings
            # the place of the highest differing bit: exact, since the numbers are below 2^53
            longest = np.maximum(longest, DEPTH - np.frexp(differ.astype(np.float64))[1])
        return longest

    def _slices(self, strings: np.ndarray, tree: np.ndarray, query: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The slices below the prefixes of length ``depth`` of pairs of tree and query."""
        prefix = strings[tree, query] >> np.uint64(DEPTH - depth)
        if depth <= self.bits:
            step = np.uint64(self.bits - depth)
            return self.table[tree, prefix << step], self.table[tree, (prefix + np.uint64(1)) << step]
        key = (tree.astype(np.uint64) << np.uint64(DEPTH)) + (prefix << np.uint64(DEPTH - depth))
        first = np.searchsorted(self.flat, key)
        last = np.searchsorted(self.flat, key + (np.uint64(1) << np.uint64(DEPTH - depth)))
        return (first - tree * self.n).astype(np.int32), (last - tree * self.n).astype(np.int32)

    def ascend(self, queries: np.ndarray):
        """All trees together from the longest prefixes to the roots, ``TURNS`` parts of the trees after each other for
        every bit: yields after each part the queries x vectors matrix of what has been met so far, and takes back by
        ``send`` which queries go on."""
        strings = self._strings(np.column_stack([queries, np.zeros(len(queries))])).astype(np.uint64)
        longest = self.descend(strings)
        met = np.zeros((len(queries), self.n), bool)
        low, high = np.zeros(strings.shape, np.int32), np.zeros(strings.shape, np.int32)  # slices already met
        going = np.ones(len(queries), bool)
        part = -(-self.trees // TURNS)
        for depth in range(int(longest.max(initial=0)), -1, -1):
            for start in range(0, self.trees, part):
                # trees whose longest prefix is shorter wait until the ascent comes to it
                tree, query = np.nonzero((longest[start:start + part] >= depth) & going)
                if not len(tree):
                    continue
                tree += start
                first, last = self._slices(strings, tree, query, depth)
                old_first, old_last = low[tree, query], high[tree, query]
                fresh = old_first == old_last  # nothing met yet: the whole slice is new
                old_first, old_last = np.where(fresh, last, old_first), np.where(fresh, last, old_last)
                for lo, hi in ((first, old_first), (old_last, last)):
                    self._meet(met, tree, query, lo, hi)
                low[tree, query], high[tree, query] = first, last
                going = yield depth, met
                if not going.any():
                    return

    def _meet(self, met: np.ndarray, tree: np.ndarray, query: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        sizes = (hi - lo).astype(np.int64)
        some = sizes > 0
        tree, query, lo, sizes = tree[some], query[some], lo[some], sizes[some]
        ends = np.cumsum(sizes)
        for a in range(0, len(sizes), PAIRS):  # bounded pieces of the slices' places
            b = min(a + PAIRS, len(sizes))
            s = sizes[a:b]
            place = np.arange(s.sum()) - np.repeat(ends[a:b] - s - (ends[a - 1] if a else 0), s) + np.repeat(lo[a:b], s)
            met[np.repeat(query[a:b], s), self.order[np.repeat(tree[a:b], s), place]] = True

    def candidates(self, queries: np.ndarray, share: float, least: int) -> np.ndarray:
        """queries x vectors: True for the candidates, at least ``least`` of them if the band has as many."""
        wanted = min(self.n, max(int(np.ceil(share * self.n)), least))
        steps = self.ascend(queries)
        met, going = np.ones((len(queries), self.n), bool), None
        try:
            while True:
                _, met = steps.send(going)
                going = met.sum(axis=1) < wanted
        except StopIteration:
            return met

    def needed(self, queries: np.ndarray) -> np.ndarray:
        """queries x vectors: a vector is among the candidates where their share is above this one."""
        out = np.ones((len(queries), self.n), np.float32)
        steps, before, going = self.ascend(queries), np.zeros((len(queries), self.n), bool), None
        try:
            while True:
                _, met = steps.send(going)
                new = met & ~before
                out[new] = np.broadcast_to(before.mean(axis=1)[:, None], met.shape)[new]
                before |= new
                going = ~before.all(axis=1)
        except StopIteration:
            return out


def _balance(vectors: np.ndarray, centred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(for vectors, for queries): matrices that keep all inner products and give the centred vectors and the
    queries, for which the vectors as they are stand, the same second moments."""
    root = lambda m, floor: (lambda w, u: (u, np.sqrt(np.maximum(w, w.max() * floor))))(*np.linalg.eigh(m))
    spread, asked = centred.T @ centred / len(centred), vectors.T @ vectors / len(vectors)
    u, w = root(spread, 1e-6)
    half, back = u * w @ u.T, u / w @ u.T
    v, m = root(half @ asked @ half, 1e-12)
    u, w = root(back @ (v * m @ v.T) @ back, 1e-9)
    return u * w, u / w


class Bands:
    """The forests of one shard, one for each range of norms."""

    def __init__(self, vectors: np.ndarray, names: np.ndarray, trees: int, seed: int) -> None:
        self.n, self.vectors, self.names = len(vectors), vectors, names
        centred = vectors - vectors.mean(axis=0)
        self.to = np.eye(vectors.shape[1])
        if centred.any():
            by, self.to = _balance(vectors, centred)
            centred = centred @ by
        norms = np.linalg.norm(centred, axis=1)
        order = np.argsort(-norms, kind="stable")
        down = -norms[order]
        self.rows: list[np.ndarray] = []
        self.forests: list[Forest] = []
        longest, at = [], 0
        while at < self.n:
            longest.append(-down[at])
            end = self.n if len(longest) == BANDS else int(np.searchsorted(down, down[at] / BAND, side="right"))
            self.rows.append(order[at:end])
            self.forests.append(Forest(centred[order[at:end]], longest[-1], trees, seed))
            at = end
        self.longest, self.sizes = np.array(longest), np.array([len(r) for r in self.rows])
        #: No product of a query with a band's vectors is above its norm times this.
        self.reach = [np.linalg.norm(vectors[r], axis=1).max() * (1 + 1e-12) for r in self.rows]

    def shares(self, share: float) -> np.ndarray:
        """The share of each band's vectors, in proportion to its longest norm, that together give ``share``."""
        out = np.ones(len(self.sizes))
        room, weight = share * self.n, self.longest * self.sizes
        for b in range(len(out)):  # from the longest norms: bands that are taken whole leave the rest to the others
            rest = weight[b:].sum()
            level = room / rest if rest > 0 else 1.0
            if level * self.longest[b] < 1:
                out[b:] = level * self.longest[b:]
                break
            room -= self.sizes[b]
        return out

    def share_for(self, queries: np.ndarray, ids: np.ndarray, share: float, k: int) -> float:
        """The least share from ``share`` on, in steps, whose candidates hold RECALL of the queries' ``k`` nearest."""
        if self.n <= k or not len(queries) or share >= 1:
            return share
        products = np.where(self.names == ids[:, None], -np.inf, queries @ self.vectors.T)
        best = np.argpartition(-products, k - 1, axis=1)[:, :k]
        live = np.isfinite(np.take_along_axis(products, best, 1))
        need, band = np.zeros((len(queries), self.n), np.float32), np.zeros(self.n, np.int64)
        for b, (rows, forest) in enumerate(zip(self.rows, self.forests, strict=True)):
            need[:, rows], band[rows] = forest.needed(queries @ self.to), b
        need, band = np.take_along_axis(need, best, 1)[live], band[best][live]
        while share < 1 and (need < self.shares(share)[band]).mean() < RECALL:
            share = min(1.0, share + STEP)
        return share

    def nearest(self, queries: np.ndarray, ids: np.ndarray, share: float, k: int) -> tuple[list[list[dict]], int]:
        """For each query the ``k`` best of its candidates, as (less: the negative product, vec_id), and the number of
        candidates of all queries."""
        asked, norms = queries @ self.to, np.linalg.norm(queries, axis=1)
        products = [np.zeros(0)] * len(queries)
        found = [np.zeros(0, np.int64)] * len(queries)
        least, seen = np.full(len(queries), -np.inf), 0
        for rows, forest, part, reach in zip(self.rows, self.forests, self.shares(share), self.reach, strict=True):
            active = np.flatnonzero(norms * reach >= least)
            met = np.ones((len(active), len(rows)), bool) if part >= 1 else forest.candidates(asked[active], part, k + 1)
            for q, hit in zip(active.tolist(), met, strict=True):
                at = rows[hit]
                seen += len(at)
                at = at[self.names[at] != ids[q]]
                at = np.concatenate([found[q], at])
                score = np.concatenate([products[q], self.vectors[at[len(found[q]):]] @ queries[q]])
                if len(at) > k:
                    edge = np.partition(score, len(at) - k)[len(at) - k]
                    keep = score >= edge  # ties at the edge are settled by id
                    at, score, least[q] = at[keep], score[keep], edge
                found[q], products[q] = at, score
        best = []
        for at, score in zip(found, products, strict=True):
            top = np.lexsort((self.names[at], -score))[:k]
            best.append([{"less": -p, "vec_id": i} for p, i in zip(score[top].tolist(), self.names[at][top].tolist(), strict=True)])
        return best, seen


def _search(k: int, trees: int, share: float, shards: int, seed: int):
    nearest_here = min(k, -(-2 * k // shards))
    kind = pa.list_(pa.struct([("less", pa.float64()), ("vec_id", pa.int64())]))

    def run(batches):
        bands, unit, part = None, None, share
        for table in units(batches, "part"):
            table = table.sort_by("vec_id")
            ids, x = table.column("vec_id").to_numpy(), matrix(table.column("embedding"))
            if table.column("block")[0].as_py() < 0:  # the shard itself comes before its queries
                bands, unit, part = Bands(x, ids, trees, seed), table.column("unit")[0].as_py(), None
                continue
            if unit != table.column("unit")[0].as_py():
                continue  # a shard without vectors of this length
            if part is None:
                some = np.unique(np.linspace(0, len(ids) - 1, SAMPLE).astype(int))
                part = bands.share_for(x[some], ids[some], share, nearest_here)
            best, _ = bands.nearest(x, ids, part, k)
            kept = [i for i, b in enumerate(best) if b]
            shard = table.column("shard")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[kept]), pa.array([shard] * len(kept), pa.int32()), pa.array([best[i] for i in kept], kind)],
                ["query_id", "shard", "best"])

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = 20, trees: int = 512, share: float = 0.05,
            shard_rows: int = 16384, query_block: int = 512, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row of ``vectors`` (vec_id, embedding)
    that the condition ``queries`` holds for."""
    rows = stored(
        vectors.where(F.col("vec_id").isNotNull() & finite_vector("embedding"))
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
        .select("vec_id", "embedding", F.size("embedding").alias("dim"), queries.alias("asks")),
        "search")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-(asked or 0) // query_block))
    own = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(shards)).cast("int")
    own_block = F.pmod(F.xxhash64("vec_id", F.lit(seed + 1)), F.lit(blocks)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    held = rows.select("vec_id", "embedding", "dim", own.alias("shard"), each(-(-blocks // GROUP)).alias("group"),
                       F.lit(-1).alias("block"))
    asking = rows.where("asks").select("vec_id", "embedding", "dim", each(shards).alias("shard"),
                                       F.floor(own_block / GROUP).cast("int").alias("group"), own_block.alias("block"))
    met = held.unionByName(asking).withColumn("unit", F.xxhash64("dim", "shard", "group"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.withColumn("part", F.xxhash64("unit", "block")).repartition(partitions, "unit").sortWithinPartitions("unit", "block")
    best = met.mapInArrow(
        _search(k, trees, share, shards, seed),
        "query_id long, shard int, best array<struct<less:double,vec_id:long>>")
    part = _merged(best.groupBy("query_id", F.floor(F.col("shard") / MERGE).alias("part")), k)
    merged = _merged(part.groupBy("query_id"), k)
    return merged.select("query_id", F.posexplode("best").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (F.lit(0.0) - F.col("hit.less")).alias("score"))


def _merged(grouped, k: int) -> DataFrame:
    """The k best of the groups' lists, each of which has k entries at most."""
    return grouped.agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
