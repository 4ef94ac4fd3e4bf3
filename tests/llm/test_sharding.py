"""Balanced sharding: the law, the slots, the groups."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runlens.llm import balanced_sharding, queries

from .helpers import DATA, docs


def check(found, texts, shards):
    assert len(found) == len(texts)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want


def cut_links(found):
    """Of the links between equal texts in a chain per text, those that cross shards."""
    shards = defaultdict(set)
    for r in found:
        shards[r["size"], r["text_crc32"]].add(r["shard"])
    return sum(len(s) - 1 for s in shards.values())


@pytest.mark.parametrize("n,shards", [(500, 16), (100, 3), (16, 16), (5, 16)])
def test_even_shards_without_gaps_and_few_cuts(spark, n, shards):
    rng = random.Random(n)
    texts = [(i, f"text {rng.randrange(n // 2)}") for i in range(n)]
    table = docs(spark, [t for _, t in texts], ids=[i for i, _ in texts]).withColumn("shard", F.lit("clash"))
    found = balanced_sharding.shard_documents(table, shards).collect()
    check(found, texts, shards)
    # at most the shards' ends cut groups, against most groups by hash
    assert cut_links(found) <= 2 * shards
    key = lambda r: (r["doc_id"], r["text_crc32"])
    again = balanced_sharding.shard_documents(table.repartition(5), shards).collect()
    assert {key(r): r["shard"] for r in again} == {key(r): r["shard"] for r in found}


def test_a_group_larger_than_a_shard_is_split_evenly(spark, monkeypatch):
    monkeypatch.setattr(balanced_sharding, "BUCKET_ROWS", 5)
    texts = [(i, "hot" if i % 3 == 0 else f"t{i // 4}") for i in range(600)]
    found = balanced_sharding.shard_documents(docs(spark, [t for _, t in texts]), 16).collect()
    check(found, texts, 16)
    hot = Counter(r["shard"] for r in found if r["text_crc32"] == zlib.crc32(b"hot"))
    assert sum(hot.values()) == 200


def test_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, None), (None, "x"), (None, "x"), (5, "é" * 200_000), (6, "a"), (6, "a"), (6, "b")]
    found = balanced_sharding.shard_documents(docs(spark, [t for _, t in texts], ids=[i for i, _ in texts]), 4).collect()
    check(found, texts, 4)
    assert balanced_sharding.shard_documents(docs(spark, [])).count() == 0


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    check(queries.QUERIES["op5_balanced_sharding"](spark, DATA).collect(), texts, 16)


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_quotas_keep_capacity(data):
    n = data.draw(st.integers(1, 6))
    counts = data.draw(st.lists(st.integers(0, 100), min_size=n, max_size=n))
    wishes = {}
    for a in range(n):
        left = counts[a]
        for b in range(n):
            if a != b:
                k = data.draw(st.integers(0, left))
                left -= k
                wishes[a, b] = k
    capacity = sum(counts) / n * 1.1
    allowed = balanced_sharding.quotas(wishes, counts, capacity)
    assert all(0 <= allowed[p] <= wishes[p] for p in wishes)
    for b in range(n):
        after = counts[b] + sum(k for (_, to), k in allowed.items() if to == b) - sum(k for (f, _), k in allowed.items() if f == b)
        assert after <= max(capacity, counts[b])
