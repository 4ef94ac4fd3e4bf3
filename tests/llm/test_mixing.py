"""Mixing sources, against a plain restatement of targets and thresholds."""

import random

import pytest
from pyspark.sql import functions as F

from runlens.llm import source_mixing
from runlens.llm.common import stored

from .helpers import docs, mixed, water, word_count

MIX = {"weights": (3.0, 1.0, 2.0), "budget": 1.5, "most": 2.0, "fills": 2}


def rows_of(n, seed, sources=("b", "a", "é", None, "Z")):
    rng = random.Random(seed)
    return [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(int(rng.paretovariate(0.8)) + 1)),
             rng.choices(sources, [9, 3, 1, 1, 1][:len(sources)])[0]) for i in range(n)]


def run(spark, rows, **mix):
    table = docs(spark, [t for _, t, _ in rows], ids=[i for i, _, _ in rows], sources=[s for _, _, s in rows])
    sizes = stored(source_mixing.sized(table.withColumn("size", F.lit("clash"))), "t")
    plan = source_mixing.Mix(sizes, **(MIX | mix))
    return table, plan, plan.taken(sizes).collect()


@pytest.mark.parametrize("n,seed", [(300, 1), (40, 2), (7, 3)])
def test_against_plain_thresholds(spark, n, seed):
    rows = rows_of(n, seed)
    table, plan, found = run(spark, rows)
    taken, goal = mixed(rows, **MIX)
    assert {r["doc_id"]: r["taken"] for r in found} == {r[0]: t for r, t in zip(rows, taken, strict=True)}
    for r in found:
        assert r["target"] == pytest.approx(goal[r["source"]]) and r["taken"] <= 2 * r["size"] == 2 * word_count(rows[r["doc_id"]][1])
    for source, target in goal.items():
        got = sum(r["taken"] for r in found if r["source"] == source)
        assert got <= target + 1e-6
        # what is left over is less than any document that could still be taken
        assert target - got <= max(word_count(t) for _, t, s in rows if s == source)
    again = {r["doc_id"]: r["taken"] for r in run(spark, rows)[2]}
    assert again == {r["doc_id"]: r["taken"] for r in found}
    copies = {r["doc_id"]: r["n"] for r in plan.repeated(table).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert copies == {r["doc_id"]: r["taken"] // r["size"] for r in found if r["taken"]}
    assert plan.repeated(table).columns == table.columns


def test_smaller_budgets_choose_subsets(spark):
    rows = rows_of(200, 5, sources=("a",))
    chosen = [{r["doc_id"] for r in run(spark, rows, budget=b, fills=0)[2] if r["taken"]} for b in (0.2, 0.5, 0.9)]
    assert chosen[0] < chosen[1] < chosen[2]


@pytest.mark.parametrize("sizes", [[100, 100, 100, 100], [1, 1000, 1, 50, 3], [0, 10, 0], [0, 0], [7]])
def test_targets_are_water_filling(spark, sizes):
    rows = spark.createDataFrame([(f"k{i}", f"s{i}", n) for i, n in enumerate(sizes)], "key string, source string, size long")
    found = {r["key"]: r["target"] for r in source_mixing.targets(rows, (3.0, 1.0, 2.0), 1.5, 2.0).collect()}
    assert [found[f"k{i}"] for i in range(len(sizes))] == pytest.approx(water(sizes, (3.0, 1.0, 2.0), 1.5, 2.0))


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n ", None), (4, "x " * 100_000, "a"), (None, "a b", "b"), (None, "c d e", "b"),
            (5, "same text", "b"), (5, "same text", "b"), (6, "q", None), (7, None, "empty")]
    _, _, found = run(spark, rows)
    taken, _ = mixed(rows, **MIX)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(((r["doc_id"], r["size"], r["taken"]) for r in found), key=key) == sorted(
        ((i, word_count(t), n) for (i, t, _), n in zip(rows, taken, strict=True)), key=key)
    assert run(spark, [])[2] == []
