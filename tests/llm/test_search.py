"""Prefix forest: recall against brute force, exactness of scores, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import prefix_forest, queries

SF = "/root/testdata/sf0.1"
VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, ids, k):
    live = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    out = {}
    for q in ids:
        near = sorted((-float(live[q] @ v), i) for i, v in live.items() if i != q and len(v) == len(live[q]))
        out[q] = [(i, -p) for p, i in near[:k]]
    return out


def run(spark, rows, ids, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("score", F.lit("clash"))
    found = {}
    for r in prefix_forest.nearest(frame, F.col("vec_id").isin(ids), **options).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(hits) for q, hits in found.items()}


def test_recall_of_the_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    x = np.array([v for _, v in sorted(rows)], np.float64)
    found = {}
    for r in queries.QUERIES["op10_prefix_forest"](spark, SF).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    hits = 0
    for q, got in found.items():
        products = x @ x[q]
        products[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -products))[:20]
        got.sort()
        assert [r for r, _, _ in got] == list(range(1, 21))
        assert all(s == pytest.approx(products[i], rel=1e-12) for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hits += len(set(best) & {i for _, i, _ in got})
    assert hits / (20 * len(found)) >= 0.9


@pytest.mark.parametrize("options", [{}, {"shard_rows": 50, "query_block": 7}])
def test_whole_ascent_is_exact(spark, options):
    """With every vector asked for, the forest finds what brute force finds, whatever the norms."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(8) * rng.uniform(0.1, 5)).astype(np.float32).tolist()) for i in range(300)]
    ids = list(range(0, 300, 11))
    found = run(spark, rows, ids, k=5, share=1.0, **options)
    want = brute(rows, ids, 5)
    assert {q: [i for _, i, _ in hits] for q, hits in found.items()} == {q: [i for i, _ in hits] for q, hits in want.items()}
    for q, hits in found.items():
        assert [s for _, _, s in hits] == pytest.approx([p for _, p in want[q]], rel=1e-12)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, nan]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [-1.0, 0.0]), (10, [1.0, 0.0, 0.0])]
    found = run(spark, rows, [0, 2, 3, 5, 6, 10, 99], k=20)
    assert found == {0: [(1, 1, 1.0), (2, 2, 1.0), (3, 9, -1.0)], 2: [(1, 0, 1.0), (2, 1, 1.0), (3, 9, -1.0)]}
    assert run(spark, rows, [1], k=1) == {1: [(1, 0, 1.0)]}
    assert run(spark, [(3, None)], [3]) == {} and run(spark, [], [3]) == {}


def test_descent_finds_the_longest_prefix():
    rng = np.random.default_rng(0)
    forest = prefix_forest.Forest(rng.standard_normal((200, 6)), 10.0, 3, 1)
    asked = forest._strings(rng.standard_normal((20, 7)))
    longest = forest.descend(asked)
    for t in range(3):
        for q in range(20):
            shared = [prefix_forest.DEPTH - (int(a) ^ int(asked[t, q])).bit_length() for a in forest.sorted[t]]
            assert longest[t, q] == max(shared)


@pytest.mark.parametrize("n", [1, 5, 300, 20_000])
def test_ascent_meets_what_shares_a_prefix(n):
    """After every bit the met vectors are those that share so long a prefix with the query in some tree."""
    rng = np.random.default_rng(n)
    vectors, trees = rng.standard_normal((n, 6)), 5
    vectors[n // 2:] = vectors[0]  # one string for half of the vectors
    forest = prefix_forest.Forest(vectors, 10.0, trees, 1)
    strings = np.zeros((trees, n), np.uint64)
    np.put_along_axis(strings, forest.order, forest.sorted, axis=1)
    queries = rng.standard_normal((4, 6))
    asked = forest._strings(np.column_stack([queries, np.zeros(4)])).astype(np.uint64)
    differ = strings[:, None, :] ^ asked[:, :, None]
    shared = (prefix_forest.DEPTH - np.frexp(differ.astype(float))[1]).max(axis=0)
    steps, by_depth, going = forest.ascend(queries), {}, None
    try:
        while True:
            depth, met = steps.send(going)
            by_depth[depth] = met.copy()
            going = np.ones(4, bool)
    except StopIteration:
        pass
    assert by_depth[0].all() and all((met == (shared >= depth)).all() for depth, met in by_depth.items())
    few = forest.candidates(queries, 0.1, 1)
    assert (few.sum(axis=1) >= min(n, max(1, n // 10))).all()


def shapes(n=3000, dim=64):
    rng = np.random.default_rng(7)
    unit = rng.standard_normal((n, dim))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    outlier = unit.copy()
    outlier[5] *= 5
    yield "outlier", outlier
    for sigma in (0.25, 0.5, 1.0):
        yield f"norms {sigma}", unit * np.exp(sigma * rng.standard_normal((n, 1)))
    shifted = np.sqrt(0.7) * np.eye(dim)[0] + np.sqrt(0.3) * unit
    yield "mean", shifted / np.linalg.norm(shifted, axis=1, keepdims=True)
    yield "axes", unit * np.geomspace(1, 30, dim)
    yield "clusters", 3 * unit[rng.integers(0, 20, n)] + unit


def share_seen(x, k=20):
    """The mean share of the vectors that a query's exact products see, and the recall, by one shard's forests."""
    names, asked = np.arange(len(x)), np.arange(0, len(x), 20)
    bands = prefix_forest.Bands(x, names, 512, 5)
    some = asked[:: max(1, len(asked) // prefix_forest.SAMPLE)]
    share = bands.share_for(x[some], some, 0.05, k)
    best, seen = bands.nearest(x[asked], asked, share, k)
    products = x[asked] @ x.T
    products[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-products, axis=1)[:, :k]
    hits = sum(len({b["vec_id"] for b in found} & set(near)) for found, near in zip(best, want.tolist(), strict=True))
    return seen / len(asked) / len(x), hits / (k * len(asked))


def test_the_forest_selects():
    """Few candidates where the vectors have structure; a minority even where they fill all directions alike."""
    clustered = dict(shapes())["clusters"]
    seen, recall = share_seen(clustered)
    assert seen <= 0.1 and recall >= 0.95
    import pyarrow.parquet as pq
    table = pq.read_table(f"{SF}/embeddings.parquet")
    seen, recall = share_seen(np.stack(table.column("embedding").to_numpy(zero_copy_only=False)).astype(float))
    assert seen <= 0.42 and recall >= 0.9


def test_bands_that_cannot_reach_are_left_out():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 8))
    x[:300] *= 50
    bands = prefix_forest.Bands(x, np.arange(len(x)), 64, 5)
    best, seen = bands.nearest(x[:5], np.arange(5), 0.999, 5)  # nearly all of every band that is opened
    want = np.argsort(-np.where(np.eye(5, 3000, dtype=bool), -np.inf, x[:5] @ x.T), axis=1)[:, :5]
    assert [[b["vec_id"] for b in found] for found in best] == want.tolist() and seen < 0.5 * 5 * 3000


@pytest.mark.parametrize("name,x", [pytest.param(n, x, id=n) for n, x in shapes()])
def test_recall_at_the_production_share(spark, name, x):
    """Unequal norms, a common mean and uneven axes, at the default share and over two shards."""
    x = x.astype(np.float32).astype(float)
    rows = list(enumerate(x.tolist()))
    ids = list(range(0, len(x), 30))
    want = brute(rows, ids, 20)
    found = run(spark, rows, ids, shard_rows=1500)
    hits = sum(len({i for _, i, _ in found[q]} & {i for i, _ in want[q]}) for q in ids)
    assert hits / (20 * len(ids)) >= 0.9
