"""Whitening: own linear algebra against numpy, whole results against a plain restatement, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import queries, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, k):
    """{vec_id: (deviation, whitened by component)} and shares, by numpy's eigh."""
    x = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + 1_000_000 for i, v in rows}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    total = np.trace(c.T @ c / n)
    deviation = lambda v: sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
    return {i: (deviation(v), (v - sums / n) @ vectors / np.sqrt(values)) for i, v in x.items()}, values / total, n


def run(spark, rows, k=16):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("n", F.lit("clash")).withColumn("x", F.lit(1))
    return whitening.whiten(frame, components=k).collect()


def held(found, rows, k):
    want, shares, n = plain(rows, k)
    by = {}
    for r in found:
        assert (r["n"], r["deviation"]) == (n, want[r["vec_id"]][0])
        assert r["identity_error"] < 1e-9 and r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-9)
        by.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    assert set(by) == set(want) and all(set(c) == set(range(1, len(shares) + 1)) for c in by.values())
    got = np.array([[by[i][c] for c in sorted(by[i])] for i in by])
    true = np.array([want[i][1] for i in by])
    signs = np.sign((got * true).sum(axis=0))
    assert np.abs(got * signs - true).max() < 1e-8


def test_the_query_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = queries.QUERIES["op11_embedding_whitening"](spark, SF)
    assert [f.name for f in found.schema] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    held(found.collect(), rows, 16)


def test_copies_count_once_in_the_fit_and_short_vectors_have_fewer_components(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 5)) * [5, 4, 3, 2, 1]
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, np.repeat(base[:1], 200, axis=0)]))]
    held(run(spark, rows), rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0]), (2, [0.0, 0.0]), (None, [1.0, 1.0]), (3, [3.0, -2.0])]
    odd = [(4, None), (5, []), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1e30, 1.0]), (10, [1.0]), (11, [1.0, 2.0, 3.0])]
    found = run(spark, good + odd)
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1) for r in found) == sorted([0, 1, 2, 2, -1, 3] * 2)
    assert {r["n"] for r in found} == {5}
    assert run(spark, []) == [] and run(spark, odd[:3]) == []
    assert run(spark, [(1, [1.0, 2.0])]) == [] and run(spark, [(1, [1.0, 2.0])] * 3) == []  # nothing varies
    one_way = run(spark, [(1, [0.0, 5.0]), (2, [1.0, 5.0]), (3, [2.0, 5.0])])  # one dimension varies
    assert {r["component"] for r in one_way} == {1} and one_way[0]["explained"] == pytest.approx(1)


def test_deviation_beyond_64_bits_is_null():
    mean = whitening.Mean(3, [10**9, 5])
    x = np.array([[10**13, 2], [333333333, 2], [0, 0]])
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(v, mean.sums, strict=True)) for v in x]
    assert mean.deviations(x) == [w if w < 1 << 63 else None for w in want]
    assert mean.deviations(x)[0] is None and mean.deviations(x)[1] is not None


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2], [5, 5, 5, 5, 1, 1, 1, 1], [1, 1, 1, 1, 1, 1, 1, 1], [1e8, 1e8 * (1 - 1e-15), 1, 1, 1e-6, 0, 0, 0],
    [3, 0, 0, 0, 0, 0, 0, 0], [2, 2 - 1e-9, 2 - 2e-9, 1, 1, 1, 1e-3, 1e-3],
])
@pytest.mark.parametrize("turned", [False, True])
def test_components_of_close_and_equal_eigenvalues(values, turned):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(4).standard_normal((d, d)))[0] if turned else np.eye(d)
    a = q * np.array(values, float) @ q.T
    a = (a + a.T) / 2
    got, vectors = whitening.leading_components(a, 6)
    norm = max(values)
    assert np.abs(got - np.array(values[:6])).max() < 1e-13 * norm * d
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * got).max() < 1e-12 * norm


def test_sturm_counts_and_tridiagonal_form():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    diagonal, off, _ = whitening.tridiagonal(a)
    true = np.linalg.eigvalsh(a)
    assert np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)) == pytest.approx(true, abs=1e-12)
    at = rng.uniform(true[0] - 1, true[-1] + 1, 200)
    assert whitening.sturm_counts(diagonal, off, at).tolist() == [(true < x).sum() for x in at]
    assert whitening.leading_components(np.array([[4.0]]), 1)[0].tolist() == [4.0]
