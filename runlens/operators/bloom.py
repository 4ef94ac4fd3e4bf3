"""Landed answers reduced to the ids that are looked up.

Only failed runs and their tasks are looked up, while outputs and details
hold an answer for everything that was ever asked. A Bloom filter of the ids
drops almost all other answers where they are read, before anything is
shuffled, sorted or ranked. The filter is a DataFrame: every id sets a few
bits of one 64-bit word, the words are the groups and ``bit_or`` merges them.
Testing an id is one join on its word.

The number of words comes from the number of ids, counted inside the plan:
``BITS`` bits an id, at most ``MAX_WORDS`` words (16 bytes each in memory), so
what is broadcast has a fixed bound. More ids than fit are split: the caller
names the number expected, ids are dealt to ``passes`` filters by another
hash, and each filter tests its share of the answers. Without that number a
filter that is too full lets more answers pass; it never drops one that is
looked up, and the joins after it stay exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of an id in its word, bits of the filter for each id, words of one filter (16 MB).
HASHES, BITS, MAX_WORDS = 4, 24, 1 << 20


def passes_for(expected: int | None) -> int:
    """Filters that ``expected`` ids need, none of them above MAX_WORDS."""
    return 1 if expected is None else max(1, -(-expected * BITS // (64 * MAX_WORDS)))


def _mask(key: Column) -> Column:
    """The bits of ``key`` in its word: HASHES places of six bits each, cut from one hash."""
    h = F.xxhash64(F.lit(2), key)
    # a shift inside a lambda-free expression stays in generated code
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function(
            "shiftright", h, F.lit(6 * i)).bitwiseAND(F.lit(63)).cast("int")) for i in range(HASHES)])


def _share(key: Column, passes: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(passes))


def bloom_filter(ids: DataFrame, key: str) -> DataFrame:
    """(word, bits, words): the filter of the values of ``ids[key]``; ``words`` is how many there can be."""
    known = ids.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    words = known.agg(F.greatest(F.lit(1), F.least(F.lit(MAX_WORDS), F.ceil(F.count(F.lit(1)) * BITS / 64))).cast("long").alias("words"))
    sized = known.withColumn("words", words.scalar())
    return sized.groupBy("words", F.pmod(F.xxhash64("key"), F.col("words")).alias("word")).agg(
        F.bit_or(_mask(F.col("key"))).alias("bits"))


def probably_in(rows: DataFrame, key: str, filter_words: DataFrame) -> DataFrame:
    """The rows whose ``key`` the filter may hold: all that it holds, and about 1 in 200 others."""
    words = filter_words.agg(F.max("words")).scalar()
    f = filter_words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    mask = _mask(F.col(key))
    # at most MAX_WORDS rows of two numbers
    return rows.withColumn("_at", F.pmod(F.xxhash64(key), words)).join(
        F.broadcast(f), (F.col("_at") == F.col("_word")) & (F.col("_bits").bitwiseAND(mask) == mask), "left_semi").drop("_at")


def looked_up(answers: DataFrame, key: str, ids: DataFrame, id_key: str, expected: int | None = None) -> DataFrame:
    """``answers`` reduced to those whose ``key`` is (almost certainly) among the ids."""
    passes = passes_for(expected)
    if passes == 1:
        return probably_in(answers, key, bloom_filter(ids, id_key))
    parts = [probably_in(answers.where(_share(F.col(key), passes) == p), key,
                         bloom_filter(ids.where(_share(F.col(id_key), passes) == p), id_key)) for p in range(passes)]
    return reduce(DataFrame.unionByName, parts)
