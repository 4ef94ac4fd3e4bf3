"""A Merkle manifest of a dataset: leaves, roots by source, proofs.

A document's leaf is the hash of its fields. The leaves of a source, in the
order of their ids, are reduced ``ARITY`` at a time to the source's subroot;
the subroots, in the order of their sources, likewise to the root. A proof
holds the siblings on the way from a leaf to the root.

Plan. Leaves are dealt by ranges of (source, id), so a large source spreads
over many tasks, and numbered from the counts of the ranges. ``ARITY ** height``
consecutive nodes of a source are one superblock, a whole subtree. Going up,
each superblock is reduced to its top node; the table of top nodes is so many
times smaller and is reduced the same way until a source has one node.
Going down, the nodes of each superblock are cogrouped with the outer nodes
that their proofs need, the siblings on the way from the superblock to the
root. The function that gets both finishes the reduction inside the block,
joins the two parts of every proof and folds it. No task holds more than a
superblock, whatever the size of a source; the driver reads no nodes.

Defined results: a null field counts as ``-``; a null source is a source of
its own, the first; rows without an id come first in theirs and are never
tampered with; rows that share an id are ordered by their leaves, equal rows
are leaves of their own. One document alone is leaf, subroot and root, with an
empty proof. An empty table gives no rows. Other columns don't count.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Consecutive nodes that become one, and levels of a superblock, which holds ARITY ** HEIGHT nodes at most.
ARITY, HEIGHT = 3, 7
DIGEST = 64
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NODE = "tree string, pos long, total long, hash string"
PATH = "tree string, pos long, hash string, nodes string, turns string, subroot string, root string"
PROVED = ("id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


def leaf(*fields: Column) -> Column:
    """The hash of a row's fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and the value as text."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
             for f in fields]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], total: int, height: int) -> list[list[str]]:
    """The levels above ``nodes``, a superblock of a tree of ``total`` nodes: up to the tree's one node, or, where the
    tree has further superblocks, all levels of a superblock."""
    levels = [nodes]
    while len(levels) <= height if total > ARITY**height else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_digest("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def _paths(levels: list[list[str]], nodes: str, turns: str) -> list[tuple[str, str]]:
    """For each node of the lowest level its siblings up to the root and its turns, two digits a level (its place in
    the run and the run's length), given those of the top node."""
    above = [(nodes, turns)]
    for level in reversed(levels[:-1]):
        here = []
        for i in range(len(level)):
            start = i - i % ARITY
            run = level[start:start + ARITY]
            siblings = "".join(run[:i - start] + run[i - start + 1:])
            upper = above[i // ARITY]
            here.append((siblings + upper[0], f"{i - start}{len(run)}{upper[1]}"))
        above = here
    return above


def fold(start: str, nodes: str, turns: str) -> str:
    """The root that ``start`` leads to with the siblings ``nodes`` and its ``turns``."""
    at = 0
    for i in range(0, len(turns), 2):
        place, others = int(turns[i]) * DIGEST, (int(turns[i + 1]) - 1) * DIGEST
        run = nodes[at:at + others]
        start = _digest(run[:place] + start + run[place:])
        at += others
    return start


def _top(height: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        total, span = int(block["total"].iloc[0]), ARITY**height
        return pd.DataFrame({"tree": block["tree"].iloc[:1].to_numpy(), "pos": [int(block["pos"].iloc[0]) // span],
                             "total": [-(-total // span)], "hash": [_levels(block["hash"].tolist(), total, height)[-1][0]]})

    return run


def _opened(block: pd.DataFrame, outer: pd.DataFrame, height: int) -> tuple[pd.DataFrame, list[tuple[str, str]]]:
    block = block.sort_values("pos")
    levels = _levels(block["hash"].tolist(), int(block["total"].iloc[0]), height)
    return block, _paths(levels, outer["nodes"].iloc[0], outer["turns"].iloc[0])


def _node_paths(height: int):
    def run(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block, paths = _opened(block, outer, height)
        return pd.DataFrame({
            "tree": block["tree"], "pos": block["pos"], "hash": block["hash"], "nodes": [n for n, _ in paths],
            "turns": [t for _, t in paths], "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0]})

    return run


def _proofs(height: int):
    def run(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block, paths = _opened(block, outer, height)
        root = outer["root"].iloc[0]
        starts = block["tampered"].where(block["tampered"].notna(), block["hash"])
        folded = [fold(s, *path) for s, path in zip(starts, paths, strict=True)]
        return pd.DataFrame({
            "id": block["id"], "leaf": block["hash"], "subroot": outer["subroot"].iloc[0], "root": root,
            "proof_sha256": [_digest(n) for n, _ in paths], "folded_root": folded, "verified": [f == root for f in folded]})

    return run


def numbered(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place of a row in its ``tree`` in the order ``by``, and the tree's ``total``.

    Rows are dealt by ranges, so the rows of a tree lie in consecutive tasks; only the counts by range and tree meet.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(rows.repartitionByRange(ranges, "tree", *by).sortWithinPartitions("tree", *by)
                   .withColumn("_id", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("_range", F.shiftright("_id", 33))
    counts = dealt.groupBy("tree", "_range").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("tree", "_range", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("total"))
    return dealt.join(counts, ["tree", "_range"]).withColumn("pos", F.col("_id") + F.col("_shift")).drop(
        "_id", "_range", "_shift")


def climb(nodes: DataFrame, name: str, height: int) -> list[DataFrame]:
    """The tables of nodes (tree, pos, total, hash) from ``nodes`` up to that in which every tree has one node."""
    tables = [nodes]
    while not tables[-1].where("total > 1").isEmpty():
        blocks = tables[-1].select("tree", "pos", "total", "hash").groupBy("tree", _block(height))
        tables.append(stored(blocks.applyInPandas(_top(height), NODE), name))
    return tables


def _block(height: int) -> Column:
    return F.floor(F.col("pos") / ARITY**height).alias("block")


def _met(nodes: DataFrame, outer: DataFrame, height: int):
    """Superblocks of ``nodes`` cogrouped with their outer nodes: ``outer`` has a row for each superblock."""
    mine = nodes.withColumn("block", _block(height)).groupBy("tree", "block")
    theirs = outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return mine.cogroup(theirs)


def paths(tables: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """``outer`` (columns PATH), the ways from the tops of ``tables`` to the root, carried down to the superblocks of
    the lowest table."""
    for table in reversed(tables[1:-1]):
        outer = _met(table.select("tree", "pos", "total", "hash"), outer, height).applyInPandas(_node_paths(height), PATH)
    return outer


def manifest(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs`` (columns FIELDS).

    ``tampered`` is the text that the verification finds (null where it is unchanged); its leaf is folded with the
    original siblings.
    """
    changed = F.lit(None).cast("string") if tampered is None else tampered
    fields = [F.col(c) for c in FIELDS]
    leaves = docs.select(*FIELDS, changed.alias("changed")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("tree"),
        leaf(*fields).alias("hash"),
        F.when(F.col("changed").isNotNull(), leaf(*fields[:-1], F.col("changed"))).alias("tampered"))
    leaves = stored(numbered(leaves, ["doc_id", "hash", "tampered"], "merkle-leaves"), "merkle-numbered")
    tables = climb(leaves, "merkle-nodes", height)

    subroots = tables[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "hash")
    sources = stored(numbered(subroots, ["source"], "merkle-subroots"), "merkle-sources")
    tops = climb(sources, "merkle-tops", height)
    whole = tops[-1].select("tree", "pos", "hash", F.lit("").alias("nodes"), F.lit("").alias("turns"),
                            F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    ways = _met(sources.select("tree", "pos", "total", "hash"), paths(tops, whole, height), height)
    outer = sources.select("pos", "source").join(ways.applyInPandas(_node_paths(height), PATH).drop("tree"), "pos").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), "hash", "nodes", "turns",
        F.col("hash").alias("subroot"), "root")
    # ids travel as text: pandas would make a column of integers and nulls one of floats
    named = leaves.withColumn("id", F.col("doc_id").cast("string")).drop("doc_id")
    proved = _met(named, paths(tables, outer, height), height).applyInPandas(_proofs(height), PROVED)
    return proved.select(F.col("id").cast("long").alias("doc_id"), "*").drop("id")
