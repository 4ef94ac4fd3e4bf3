"""Shared lines: whole results against a plain restatement, the runs against plain counts, odd rows."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import line_dedup

from .helpers import docs

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def plain(texts, min_docs, min_chars):
    seen = Counter(k for t in texts for k in {key(line) for line in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [line for line in lines if len(key(line)) < min_chars or seen[key(line)] < min_docs]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def run(spark, texts, min_docs=3, min_chars=1, partitions=4, **options):
    frame = docs(spark, texts).repartition(partitions).withColumn("doc_key", F.lit("clash")).withColumn("lines", F.lit(1))
    made = line_dedup.without_shared_lines(frame, min_docs, min_chars, **options)
    assert made.columns == [*frame.columns, "kept"]
    rows = sorted(made.collect(), key=lambda r: r["doc_id"])
    assert [r["text"] for r in rows] == texts and {(r["doc_key"], r["lines"]) for r in rows} <= {("clash", 1)}
    return [tuple(r["kept"]) for r in rows]


def corpus(n=200, seed=1):
    rng = np.random.default_rng(seed)
    pool = [f"Line {i} " + "x" * (i % 7) for i in range(150)] + ["", "  ", "É", "é", "iİ"]
    texts = ["\n".join([*(pool[j] if rng.random() < .7 else " \t" + pool[j].upper() + "\r" for j in rng.zipf(1.4, rng.integers(1, 12)) % len(pool)),
                        *(["all have it"] if i % 3 else [])]) for i in range(n)]
    return texts + texts[:40]


@pytest.mark.parametrize("batches,min_docs,min_chars", [(1, 3, 1), (3, 10, 5), (4, 3, 1), (7, 10, 1)])
def test_against_plain_counts(spark, batches, min_docs, min_chars):
    texts = corpus()
    found = run(spark, texts, min_docs, min_chars, partitions=9, batches=batches)
    assert found == plain(texts, min_docs, min_chars)
    assert any(n for _, _, n in found) and any(n == 0 for _, _, n in found)


def test_hot_keys_go_the_broadcast_way(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_KEYS", 4)
    texts = corpus(120)
    assert run(spark, texts, 2) == plain(texts, 2, 1)


def test_odd_rows(spark):
    long = "\n".join(f"own line {i}" for i in range(20_000))
    texts = [None, "", "\n", "\n\n", "a", "A ", "\ta\nb", "b\r\nA", "a\na\na", long, "w" * 500_000, "B", " a", "a a"]
    assert run(spark, texts) == plain(texts, 3, 1)
    assert run(spark, texts, min_chars=2) == plain(texts, 3, 2)
    assert run(spark, [], partitions=1) == [] and run(spark, [None, ""]) == [("", 1, 0)] * 2
    twice = docs(spark, ["same\nown"] * 3 + ["same"], ids=[7, 7, None, None])
    found = line_dedup.without_shared_lines(twice, 4).select("kept.text").collect()
    assert sorted(r["text"] for r in found) == ["", "own", "own", "own"]


def test_runs_are_levelled_and_settled_keys_leave(spark):
    runs = line_dedup.Runs(spark, min_docs=5)
    batches = [[(1, 3), (2, 9)], [(1, 1), (2, 9), (3, 1)], [(2, 4), (1, 1)], [(2, 1), (4, 5)], [(1, 2)]]
    for n, batch in enumerate(batches, 1):
        frame = spark.createDataFrame([(h, 0, c) for h, c in batch], "h long, g long, n long")
        runs.add(runs.sorted_run(frame))
        assert [run is not None for run in runs.levels] == [n >> b & 1 == 1 for b in range(len(runs.levels))]
    counted = {r["h"]: r["n"] for run in runs.levels if run is not None for r in run.collect() if r["h"] == 2}
    assert counted == {2: 9}  # settled by the first batch: later ones add nothing
    assert sorted(r["h"] for r in runs.common().collect()) == [1, 2, 4]


def test_runs_are_merged_without_a_shuffle(spark):
    runs = line_dedup.Runs(spark, min_docs=5)
    rows = spark.range(1000).select(F.col("id").alias("h"), F.lit(0).cast("long").alias("g"), F.lit(1).cast("long").alias("n"))
    a, b = runs.sorted_run(rows), runs.sorted_run(rows)
    for joined in (runs.merged(a, b), a.join(b.select("h", "g").hint("merge"), ["h", "g"], "left_anti")):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
