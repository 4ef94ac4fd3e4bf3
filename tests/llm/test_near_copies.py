"""SimHash and embedding near-copies, connected components and bounded groups, against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runlens.llm import common, embedding_dedup, queries, simhash_dedup

from .helpers import DATA, docs, roots, simhash


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "Ça", "d,", "e", " ", "\n", " x", "\x0b", "a b c"]), max_size=30), st.integers(1, 4))
def test_fingerprint_against_plain_counting(words, shingle):
    text = " ".join(words)
    assert simhash_dedup.fingerprint(text.encode(), shingle) == signed(simhash(text, shingle))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 6), st.integers(1, 200), st.integers(0, 2**32))
def test_bit_slices_against_counting_bits(radius, n, seed):
    rng = random.Random(seed)
    centre = rng.getrandbits(64)
    values = []
    for _ in range(n):
        v = centre if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randrange(6)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    i, j = simhash_dedup.close_pairs(np.array(values, np.uint64), radius)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {
        (a, b) for b in range(n) for a in range(b) if (values[a] ^ values[b]).bit_count() <= radius}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60), st.lists(st.tuples(st.integers(0, 59), st.integers(0, 59)), max_size=120), st.integers(0, 99))
def test_tree_links_connect_the_same(n, pairs, seed):
    pairs = [(a % n, b % n) for a, b in pairs]
    nodes = np.array(random.Random(seed).sample(range(-500, 500), n))
    a, b = tree_of = common.tree_links(nodes, np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int))
    links, tree = {(nodes[x], nodes[y]) for x, y in pairs}, set(zip(*(t.tolist() for t in tree_of), strict=True))
    either = lambda links: roots(sorted(nodes.tolist()), lambda x, y: (x, y) in links or (y, x) in links)
    assert either(tree) == either({(int(x), int(y)) for x, y in links})
    degree = np.bincount(np.searchsorted(np.sort(nodes), np.concatenate([a, b])), minlength=n)
    assert len(a) < n and degree.max(initial=0) <= common.TREE_DEGREE + 1


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(-5, -5), (2000, 2001), (2001, 2000)]
    links += [(3000 + rng.randrange(200), 3000 + rng.randrange(200)) for _ in range(150)]
    nodes = sorted({x for p in links if p[0] != p[1] for x in p})
    place = {x: i for i, x in enumerate(nodes)}
    root = common.local_roots(len(nodes), *(np.array([place[p[k]] for p in links if p[0] != p[1]]) for k in (0, 1)))
    found = common.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {x: nodes[root[place[x]]] for x in nodes}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [1, 3, 100])
def test_block_pairs_meet_once_in_bounded_units(spark, block):
    rows = spark.createDataFrame([("a", i) for i in range(20)] + [("b", 1), ("b", 2), ("c", 5)], "key string, id long")
    met = common.block_pairs(rows, ["key"], "id", block).collect()
    units = {}
    for r in met:
        units.setdefault(r["unit"], []).append(r)
    pairs = [(x["key"], *sorted((x["id"], y["id"]))) for rows in units.values() for k, x in enumerate(rows) for y in rows[:k]
             if (x["lo"] == x["hi"]) or x["own_block"] != y["own_block"]]
    assert sorted(pairs) == sorted([("a", i, j) for j in range(20) for i in range(j)] + [("b", 1, 2)])


def brute(rows, shingle=3, radius=2):
    """component_id by position for rows of (doc_id, text)."""
    prints = [simhash(t, shingle) for _, t in rows]
    root = roots(prints, lambda a, b: (a ^ b).bit_count() <= radius)
    low = {}
    for r, (i, _) in zip(root, rows, strict=True):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return prints, root, [low.get(r) for r in root]


def odd_texts():
    rng = random.Random(1)
    base = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(99)) for _ in range(400))
    near = [base.replace("alpha", "ALPHA", k) + f" tail{k}" for k in range(12)]
    return [None, "", "  ", "one", "One", "two words", base, base, *near, "x " * 200_000, "y" * 300_000]


def test_simhash_groups_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = {r["doc_id"]: r for r in queries.QUERIES["op6_simhash_near_dedup"](spark, DATA).collect()}
    prints, _, component = brute(rows)
    assert {i: (f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, component, strict=True)} == {
        i: (r["fingerprint"], r["component_id"]) for i, r in found.items()}


def test_simhash_groups_of_odd_rows(spark):
    texts = odd_texts()
    ids = [*range(len(texts) - 2), None, 7]
    table = docs(spark, texts, ids=ids).withColumn("fp", F.lit("clash"))
    prints, _, component = brute(list(zip(ids, texts, strict=True)))
    found = simhash_dedup.groups(table, block=4).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in found), key=key) == sorted(
        ((i, signed(p), c) for i, p, c in zip(ids, prints, component, strict=True)), key=key)
    assert simhash_dedup.groups(table.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    texts = odd_texts()
    ids = [*range(len(texts) - 2), None, 7]
    rows = list(zip(ids, texts, strict=True)) * 2
    table = docs(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    kept = simhash_dedup.one_per_group(table).collect()
    prints, root, component = brute(rows)
    assert len(kept) == len(set(root))
    group = {(i, t): (r, c) for (i, t), r, c in zip(rows, root, component, strict=True)}
    assert {group[r["doc_id"], r["text"]][0] for r in kept} == set(root)
    assert all(r["doc_id"] == group[r["doc_id"], r["text"]][1] for r in kept)
    assert kept[0].asDict().keys() == set(table.columns)


# ------------------------------------------------------------------ vectors
VECTORS = "vec_id long, embedding array<float>, label int"


def brute_vectors(rows, threshold=0.98):
    def vector(r):
        ok = r[0] is not None and r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])
        return np.array(r[1], np.float32).astype(float) if ok else None

    live = [vector(r) for r in rows]

    def linked(i, j):
        if live[i] is None or live[j] is None or rows[i][2] != rows[j][2] or len(live[i]) != len(live[j]):
            return False
        return live[i] @ live[j] / np.sqrt(live[i] @ live[i]) / np.sqrt(live[j] @ live[j]) >= threshold

    at = range(len(rows))
    root = roots(list(at), linked)
    low = {}
    for i, r in zip(at, root, strict=True):
        if rows[i][0] is not None:
            low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    return [(rows[i][0], sum(linked(i, j) for j in at if j != i), low.get(root[i])) for i in at]


def check_vectors(spark, rows):
    found = embedding_dedup.near_copies(spark.createDataFrame(rows, VECTORS).withColumn("rep", F.lit(1))).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=key) == sorted(brute_vectors(rows), key=key)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"] or r["vec_id"] is None) for r in found)


def test_groups_larger_than_the_window_lose_no_link(spark):
    rng = np.random.default_rng(4)
    rows = []
    for size, noise in ((300, 0.011), (40, 0.016), (2, 0.01), (2, 0.01), (3, 0.012)):
        centre = rng.standard_normal(64)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append((centre + noise * rng.standard_normal(64)).astype(np.float32).tolist())
    rows += rng.standard_normal((150, 64)).astype(np.float32).tolist()
    ids = rng.permutation(len(rows)).tolist()
    check_vectors(spark, [(i, v, k % 2 if k > 400 else 0) for k, (i, v) in enumerate(zip(ids, rows, strict=True))])


@pytest.mark.parametrize("block", [100, embedding_dedup.BLOCK])
def test_links_that_straddle_the_threshold(spark, block):
    """One group of near-copies around the threshold, and pairs planted in a label with a common background."""
    rng = np.random.default_rng(6)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.standard_normal((n, 64)))
    at = lambda base, cosine: (lambda side: cosine[:, None] * base + np.sqrt(1 - cosine[:, None] ** 2) * side)(
        (lambda s: s / np.linalg.norm(s, axis=1, keepdims=True))((r := unit(len(base))) - (r * base).sum(1)[:, None] * base))
    centre = unit(1)
    group = at(np.repeat(centre, 1200, 0), rng.uniform(0.97, 1, 1200))
    back = at(np.repeat(centre, 600, 0), np.full(600, 0.8**0.5))
    back[300:] = at(back[:300], rng.uniform(0.98, 0.99, 300))
    x = np.concatenate([group, back]).astype(np.float32)
    label = np.repeat([0, 1], [1200, 600])
    wide = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (wide @ wide.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    root = common.local_roots(len(x), *np.nonzero(near))
    found = embedding_dedup.near_copies(
        spark.createDataFrame([(i, v, int(k)) for i, (v, k) in enumerate(zip(x.tolist(), label, strict=True))], VECTORS), block=block)
    assert [(r["n_links"], r["component_id"]) for r in found.orderBy("vec_id").collect()] == list(
        zip(near.sum(1).tolist(), root.tolist(), strict=True))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    check_vectors(spark, [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 0), (3, [1.0, 0.0], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None),
        (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, [1.0, nan], 0), (10, [inf, 0.0], 0), (11, [1.0, None], 0),
        (12, [1.0, 0.0, 0.0], 0), (13, [-0.0, 1.0], 0), (14, [0.0, 1.0], 0), (None, [1.0, 0.0], 0), (15, [1.0, 0.21], 0)])


def test_no_vectors(spark):
    assert embedding_dedup.near_copies(spark.createDataFrame([], VECTORS)).count() == 0
