"""Near-copies of documents by SimHash, compared in bit slices.

Fingerprint. Words are runs of bytes other than ASCII white space after
lower-casing A-Z; every ``shingle`` words in a row (repeats included; all
words if there are fewer) are joined by spaces and hashed by XXH64 with seed
42. A bit of the 64-bit fingerprint is set if it is set in over half of the
hashes. A text without words has fingerprint 0.

Links. Documents of equal fingerprints are folded first, so a group of
copies of any size is one fingerprint afterwards. Two fingerprints at most
``radius`` bits apart agree in at least one of ``radius + 1`` bands of bits;
fingerprints that share a band's value are candidates. A band value that very
many fingerprints share is cut into bounded blocks that meet pairwise, so no
pair is lost and no task holds the whole group.

Comparison. A unit's fingerprints are stored as 64 bit planes, each plane one
bit per fingerprint. All fingerprints are compared with 64 at a time: plane by
plane the differing bits are added to bitwise counters by carry-save steps;
after every few planes the words of 64 in which every distance exceeds the
radius are abandoned.

A unit hands on only a spanning forest of the links it verified; connected
components over these give each document's group.

Defined results: null texts count as empty; the fingerprint 0 links like any
other; rows that share a doc_id are each fingerprinted; the component of rows
whose ids are all null is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import block_pairs, bounded_batches, by_unit, connected_components, stored, tree_links, units

BITS = 64
#: Fixed value: the seed of XXH64.
SEED = 42
#: Fingerprints of one block; a unit compares two blocks at most.
BLOCK = 512
#: Planes between two looks for words to abandon.
SLAB = 8
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of one text, as a signed 64-bit number."""
    words = text.lower().split() if text else []
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        n, shingle = 1, len(words)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:n - 1]]).tolist()
    stops = (ends[shingle - 1:shingle - 1 + n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, out: str = "_fp") -> DataFrame:
    """``docs`` with the column ``out``: the fingerprint of each whole text as a long."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())

    return docs.withColumn(out, run(F.col("text").cast("binary")))


# ------------------------------------------------------------------ bit-sliced comparison
def planes_of(values: np.ndarray) -> np.ndarray:
    """64 x words: bit j of word w in plane i is bit i of values[64 * w + j]."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[:len(values)] = values
    bits = (padded[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)
    packed = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little")
    return packed.view("<u8")


def beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Bits set where the counted distance exceeds the radius."""
    more, equal = over.copy(), ~over
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def close_pairs(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of all values at most ``radius`` bits apart."""
    n = len(values)
    planes = planes_of(values)
    words = planes.shape[1]
    query = np.repeat(np.arange(n), words)
    word = np.tile(np.arange(words), n)
    later = word * 64 + 63 > query  # words that hold only earlier values have nothing to add
    query, word = query[later], word[later]
    size = max(1, int(radius).bit_length())
    counters = [np.zeros(len(query), np.uint64) for _ in range(size)]
    over = np.zeros(len(query), np.uint64)
    for plane in range(BITS):
        own = (np.uint64(0) - ((values >> np.uint64(plane)) & np.uint64(1)))[query]
        carry = planes[plane][word] ^ own
        for k in range(size):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if plane % SLAB == SLAB - 1:
            far = beyond(counters, over, radius)
            live = far != ALL
            if not live.all():
                query, word, over = query[live], word[live], over[live]
                counters = [c[live] for c in counters]
                if not len(query):
                    break
    near = ~beyond(counters, over, radius)
    bits = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    at, bit = np.nonzero(bits)
    i, j = query[at], word[at] * 64 + bit
    right = (j > i) & (j < n)
    return i[right], j[right]


def _forest(radius: int):
    def run(batches):
        for unit in units(batches):
            # a fingerprint is there once, or twice when both of its unit's blocks are its own
            signed = np.unique(unit.column("_fp").combine_chunks().to_numpy(zero_copy_only=False))
            if len(signed) < 2:
                continue
            i, j = close_pairs(signed.view(np.uint64), radius)
            a, b = tree_links(signed, i, j)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def links(distinct: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect the fingerprints ``_fp`` (each there once) as all pairs within ``radius`` do."""
    bands = radius + 1
    edges = [BITS * i // bands for i in range(bands + 1)]
    fp = F.col("_fp")
    parts = [F.struct(F.lit(i).alias("band"),
                      F.shiftrightunsigned(F.shiftleft(fp, BITS - hi), BITS - hi + lo).alias("value"))
             for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    banded = distinct.select("_fp", F.explode(F.array(*parts)).alias("_part")).select("_fp", "_part.*")
    met = by_unit(block_pairs(banded, ["band", "value"], "_fp", block).select("unit", "_fp"))
    return met.mapInArrow(_forest(radius), "a long, b long")


# ------------------------------------------------------------------ operator
def groups(docs: DataFrame, shingle: int = 3, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id), one row per document: the fingerprint, the smallest
    fingerprint reachable over steps of at most ``radius`` bits, and the smallest doc_id of the documents
    reachable so. ``text_key`` is a hash of the text, to tell apart rows that share an id."""
    rows = stored(
        fingerprints(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), shingle)
        .select("doc_id", "text_key", F.col("_fp").alias("fp")), "simhash")
    return rows.join(components(rows, radius, block), "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def components(rows: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of ``rows`` (doc_id, fp)."""
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    edges = links(distinct.select(F.col("fp").alias("_fp")), radius, block)
    roots = stored(connected_components(edges).withColumnRenamed("node", "fp"), "simhash-roots")
    smallest = roots.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("smallest"))
    linked = roots.join(smallest, "root")
    return (distinct.join(linked, "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root"),
                    F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id")))


def one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-copies: one row of each group stays, of the group's smallest doc_id and
    of its texts under that id the one whose hash is lowest."""
    first = (
        groups(docs, shingle, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root").agg(F.min(F.struct("text_key", "doc_id")).alias("_kept"))
        .select(F.col("_kept.text_key").alias("text_key"), _id_key(F.col("_kept.doc_id")).alias("id_key"))
    )
    # whole rows travel as one struct, so no column of theirs clashes with the keys
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_key"), _id_key(F.col("doc_id")).alias("id_key"))
    keys = ["text_key", "id_key"]
    return keyed.join(first, keys, "left_semi").dropDuplicates(keys).select("row.*")


def _id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))
