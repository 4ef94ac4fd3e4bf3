"""Merkle manifest: whole results against a plain restatement, several superblocks, odd rows."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from runlens.llm import merkle_manifest, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """(top, [(siblings, runs)] of each node): runs are (place, run) level by level."""
    ways = [[] for _ in nodes]
    at, level = list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, p in enumerate(at):
            start = p - p % 3
            ways[i].append((p - start, level[start:start + 3]))
            at[i] = p // 3
        level = [digest("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], ways


def plain(rows):
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops, found = [], []
    for s in order:
        mine = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        tops.append(tree([plain_leaf(r) for r in mine]))
        found.append(mine)
    root, upper = tree([t for t, _ in tops])
    out = []
    for (top, ways), mine, above in zip(tops, found, upper, strict=True):
        for row, way in zip(mine, ways, strict=True):
            whole = [*way, *above]
            proof = "".join("".join(run[:p] + run[p + 1:]) for p, run in whole)
            picked = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            text = row[4].replace("\n", "") if picked and row[4] is not None else row[4]
            at = plain_leaf([*row[:4], text])
            for p, run in whole:
                at = digest("".join([*run[:p], at, *run[p + 1:]]))
            out.append((row[0], plain_leaf(row), top, root, digest(proof), at, at == root))
    return sorted(out, key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit("clash")).withColumn("pos", F.lit(9))
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    made = merkle_manifest.manifest(frame, F.when(picked, F.replace("text", F.lit("\n"), F.lit(""))), **options)
    assert made.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in made.collect()), key=str)


def documents(n, sources):
    return [(i * 7, sources[i % len(sources)], "en" if i % 3 else None, i, f"line {i}\nmore" if i % 4 else f"é{i}") for i in range(n)]


@pytest.mark.parametrize("n,sources", [(1, ["a"]), (2, ["a"]), (3, ["a"]), (4, ["a"]), (10, ["a", "b", None, "É", "Z", "b "])])
def test_small_trees(spark, n, sources):
    rows = documents(n, sources)
    assert run(spark, rows) == plain(rows)


def test_several_superblocks(spark):
    """Blocks of nine nodes: three tables of nodes in one source, two in another, two of sources."""
    rows = documents(300, ["hot"]) + [(10_000 + i, f"s{i % 13}", None, None, None if i % 5 else "x\n\n") for i in range(60)]
    found = run(spark, rows, height=2)
    assert found == plain(rows)
    assert 0 < sum(not r[-1] for r in found) < len(found)


def test_the_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*merkle_manifest.FIELDS).collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op12_merkle_manifest"](spark, sf).collect()), key=str) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "a", None, None, "t\n"), (1, None, "", 0, ""), (1, None, "", 0, ""),
            (1, None, "x", 0, ""), (-5, "a", "l", -3, "\n" * 10), (2, "", "l", 1, "w" * 300_000 + "\n"), (2**62, "a", "-", 1, "-")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    frame = spark.createDataFrame(rows, SCHEMA)
    assert merkle_manifest.manifest(frame).where("not verified").isEmpty()  # nothing was tampered with
