"""Near-copies of vectors by exact products of bounded blocks.

Equal vectors of one label are folded first. The distinct ones of a label
are cut into blocks that meet pairwise; a unit of two blocks computes all
their cosines, counts the partners of each vector and hands on a spanning
forest of its links, never the pairs. The forests of all units are united by
connected components. So no link is missed, whatever the size of a group and
however the vectors lie, and the work grows with the square of the largest
label.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, rows without a label and rows without a vec_id link
with nothing; their component is their own id. Vectors of unequal length
never link. A repeated row is a copy and links with its twin. Rows that share
a vec_id but not the vector count as one node of the graph.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (block_pairs, by_unit, connected_components, finite_vector, matrix, stored, tree_links, units)

#: Vectors of one block; a unit compares two blocks at most, in strips of rows that bound its memory.
BLOCK, STRIP = 2048, 256


def _unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _partners(threshold: float):
    def run(batches):
        for unit in units(batches):
            rep, copies = unit.column("rep").to_numpy(), unit.column("copies").to_numpy()
            own, lo, hi = (unit.column(c).to_numpy() for c in ("own_block", "lo", "hi"))
            x = _unit_rows(matrix(unit.column("embedding")))
            left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for at in range(0, len(left), STRIP):
                part = left[at:at + STRIP]
                i, j = np.nonzero(x[part] @ x[right].T >= threshold)
                i, j = part[i], right[j]
                once = i < j if lo[0] == hi[0] else slice(None)
                found.append((i[once], j[once]))
            i, j = (np.concatenate(side) for side in zip(*found, strict=True))
            counts = np.zeros(len(rep), np.int64)
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            used = np.flatnonzero(counts)
            if not len(used):
                continue
            a, b = tree_links(rep, i, j)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rep[used], a])), pa.array([None] * len(used) + b.tolist(), pa.int64()),
                 pa.array(counts[used].tolist() + [None] * len(a), pa.int64())], ["rep", "to", "partners"])

    return run


def links_and_counts(distinct: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Over all pairs of vectors of one label and length in ``distinct`` (rep, label, dim, copies, embedding): rows
    (rep, null, partners), to be summed by rep, that count the rows linked with a vector, and rows (rep, to, null),
    links that connect what is linked."""
    met = by_unit(block_pairs(distinct, ["label", "dim"], "rep", block))
    met = met.select("unit", "rep", "copies", "own_block", "lo", "hi", "embedding")
    return met.mapInArrow(_partners(threshold), "rep long, to long, partners long")


def near_copies(vectors: DataFrame, threshold: float = 0.98, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    taking_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite_vector("embedding")
    rows = stored(
        vectors.select("vec_id", "label", "embedding", taking_part.alias("_in"))
        .select("vec_id", "_in", F.when(F.col("_in"), F.col("label").cast("long")).alias("label"),
                F.when(F.col("_in"), F.col("embedding")).alias("embedding"))
        .withColumn("key", F.when(F.col("_in"), F.md5(F.to_json(F.struct("embedding")).cast("binary")))),
        "vectors")
    live = rows.where("_in")
    distinct = stored(
        live.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                         F.min("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding")), "vectors-distinct")
    found = stored(links_and_counts(distinct, threshold, block), "vectors-links")
    links = found.where("to IS NOT NULL").select(F.col("rep").alias("a"), F.col("to").alias("b"))
    roots = stored(connected_components(links).withColumnRenamed("node", "rep"), "vectors-roots")
    counted = found.where("to IS NULL").groupBy("rep").agg(F.sum("partners").alias("partners"))
    classes = (
        distinct.select("label", "key", "rep", "copies").join(roots, "rep", "left").join(counted, "rep", "left")
        .select("label", "key", (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"),
                F.coalesce("root", "rep").alias("component_id"))
    )
    linked = rows.select("vec_id", "label", "key").join(classes, ["label", "key"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return linked.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
