"""Helpers shared by the operators of this subpackage.

Nothing here collects rows: tables that later steps read again are written
to the shared checkpoint folder, groups that a key makes large are cut into
bounded blocks, and connected components are found by joins that contract
the graph.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Texts that one Arrow batch holds at most; bounds a Python worker's memory by a few hundred whole texts.
BATCH_ROWS = 256


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Arrow batches of at most ``rows`` rows in this session (whole texts can be long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where that is unset, a temporary folder if
    Spark runs in one process (tests), else a folder in the warehouse."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_dir(spark)
    one_process = spark.sparkContext.master.split("[")[0] == "local"
    fallback = tempfile.mkdtemp(prefix="runlens-shared-") if one_process else (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return checkpoint_dir(spark, fallback=fallback)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: computed once, lineage cut, sizes known."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/runlens-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: the fold of a row."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def finite_vector(c: str) -> Column:
    """True for a vector that takes part: not null, not empty, every component finite, not all zero."""
    v = F.col(c)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """An Arrow list column of equally long vectors as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1)


# ------------------------------------------------------------------ bounded groups
def block_pairs(rows: DataFrame, key: list[str], by: str, block: int) -> DataFrame:
    """Cut every group of ``key`` into blocks of about ``block`` rows (by a hash of ``by``) and emit each row
    once for every block of its group, so that any two rows of a group meet in exactly one unit.

    Adds ``unit`` (a hash of key and the two block numbers), ``own_block``, ``lo`` and ``hi``. A unit holds at
    most two blocks, whatever the size of the group; groups of one row are left out, they have no pairs. A pair
    of rows in one block meets in the unit ``lo = hi``.
    """
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    cut_rows = (
        rows.join(sizes, key)
        .withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
        .withColumn("own_block", F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("lo", F.least("own_block", "_other"))
        .withColumn("hi", F.greatest("own_block", "_other"))
    )
    return cut_rows.withColumn("unit", F.xxhash64(*key, "lo", "hi")).drop("_n", "_blocks", "_other")


def by_unit(rows: DataFrame, unit: str = "unit") -> DataFrame:
    """Rows dealt by ``unit``, each unit's rows together in one partition. The number of partitions is given, else
    few bytes that mean much work would be put into one task."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, unit).sortWithinPartitions(unit)


def units(batches: Iterable[pa.RecordBatch], unit: str = "unit") -> Iterator[pa.Table]:
    """The units of a stream of batches that is sorted by ``unit``, one table each. Only the unit that a batch
    boundary cuts is carried over."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(batch.schema.get_field_index(unit)).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            if held and held_key != keys[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held_key = keys[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


# ------------------------------------------------------------------ graphs
#: Children of a node in the trees that stand for a task's links: no node gets many links, and trees stay flat.
TREE_DEGREE = 16


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def tree_links(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect ``nodes`` just as the links between positions (a, b) do, at most one per node: within
    a component, sorted by node, position i hangs below position (i - 1) // TREE_DEGREE."""
    order = np.argsort(nodes, kind="stable")
    place = np.empty(len(nodes), np.int64)
    place[order] = np.arange(len(nodes))
    root = local_roots(len(nodes), place[a], place[b])
    groups = np.argsort(root, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], root[groups][1:] != root[groups][:-1]]))
    rank = np.arange(len(nodes)) - np.repeat(starts, np.diff(np.append(starts, len(nodes))))
    first = np.arange(len(nodes)) - rank
    child = rank > 0
    parent = first[child] + (rank[child] - 1) // TREE_DEGREE
    ordered = nodes[order][groups]
    return ordered[parent], ordered[child]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of longs), root the smallest node reachable.

    Each round maps a node to its smallest neighbour's smallest neighbour if that is smaller, renames the links
    and drops loops and repeats, so the graph shrinks until no link is left. A large component needs no task
    that holds it: the minimum is pre-aggregated and the renaming is a join on nodes.
    """
    # written tables, not checkpoints: those keep the estimates of the joins they come from, which multiply up
    edges = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    found = ends.select("node", F.col("node").alias("root"))
    while not edges.isEmpty():
        sides = edges.select(F.col("a").alias("n"), F.col("b").alias("to")).union(edges.select("b", "a"))
        step = sides.groupBy("n").agg(F.min("to").alias("to")).where("to < n")
        step = stored(step, "steps")
        on = step.select(F.col("n").alias("to"), F.col("to").alias("next"))
        move = stored(step.join(on, "to", "left").select("n", F.coalesce("next", "to").alias("to")), "moves")
        found = stored(found.join(move, found["root"] == move["n"], "left")
                       .select("node", F.coalesce("to", "root").alias("root")), "roots")
        for side in ("a", "b"):
            renamed = move.select(F.col("n").alias(side), F.col("to").alias(f"new_{side}"))
            edges = edges.join(renamed, side, "left").withColumn(side, F.coalesce(f"new_{side}", side)).drop(f"new_{side}")
        edges = stored(edges.where("a <> b")
                       .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return found
