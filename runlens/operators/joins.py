"""Join helpers for lookups.

No broadcast is hinted: ``spark.sql.autoBroadcastJoinThreshold`` and AQE
decide from sizes, at plan time and again from the real shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A character no key of an API holds: keys that begin with it match nothing.
NO_KEY = "\x00"


def unique_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key (the greatest when a key was landed twice), so a
    lookup join never multiplies rows."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))


def spread_key(key: Column, *row: Column | str) -> Column:
    """A text lookup key whose nulls are spread over the partitions of a shuffle
    join: a null becomes a text that matches nothing and differs by ``row``."""
    return F.coalesce(key, F.concat(F.lit(NO_KEY), F.xxhash64(*row).cast("string")))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``, ties settled by a hash of the row.

    A rank with a limit of one: Spark applies the limit in every partition
    before the shuffle, and a join on the first keys reuses the exchange and
    the sort. Only one row per task is held, whatever its width.
    """
    others = [c for c in df.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*others)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


# A key is heavy above so many rows of a side, or above its side's rows divided
# by HEAVY_KEYS: so a side has at most HEAVY_KEYS heavy keys.
HEAVY_ROWS, HEAVY_KEYS = 100_000, 1_000


def heavy_keys(left: DataFrame, right: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(key, lefts, rights): the keys that are heavy on one side and found on
    both, with the number of chunks each side is cut into. At most twice
    HEAVY_KEYS rows, from partial counts."""
    def counted(side: DataFrame, name: str) -> DataFrame:
        counts = side.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
        total = counts.agg(F.coalesce(F.sum(name), F.lit(0)).alias("n")).scalar()
        return counts.withColumn(f"{name}_bound", F.greatest(F.lit(heavy_rows), F.ceil(total / HEAVY_KEYS)))

    both = counted(left, "l").join(counted(right, "r"), key)
    chunks = lambda n: F.ceil(F.col(n) / F.col(f"{n}_bound")).cast("int")
    return both.where("l > l_bound OR r > r_bound").select(key, chunks("l").alias("lefts"), chunks("r").alias("rights"))


def dealt(side: DataFrame, heavy: DataFrame, key: str, own: str, other: str) -> DataFrame:
    """``side`` with its rows' places in the grid of chunks: ``own`` by a hash of the row, and a copy for each chunk of
    the other side. Light keys have the one place (0, 0)."""
    place = F.pmod(F.xxhash64(*side.columns), F.coalesce(own, F.lit(1))).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
    rows = side.join(F.broadcast(heavy), key, "left")
    return rows.select(*side.columns, place.alias(f"_{own}"), copies.alias(f"_{other}"))


def split_join(left: DataFrame, right: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Inner join on ``key`` for keys that are heavy on both sides: a heavy
    key's rows are cut into chunks on each side, and every pair of chunks is
    one group of the join. A pair of rows meets once; no group has more rows
    than the bounds, where splitting one side alone would send all rows of the
    other to every task."""
    heavy = heavy_keys(left, right, key, heavy_rows)
    a = dealt(left, heavy, key, "lefts", "rights")
    b = dealt(right, heavy, key, "rights", "lefts")
    return a.join(b, [key, "_lefts", "_rights"]).drop("_lefts", "_rights")
