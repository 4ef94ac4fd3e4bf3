"""K14 for filters on any of the ids: Z-order, and a table of file bounds.

Rows sorted by job, run and task id are found quickly by job id alone. Here
each id is turned into the number of its bucket among equal-sized ones (cut
points from a sketch, a fixed number whatever the data), and the bits of the
buckets are interleaved: rows near each other in all ids get keys near each
other, so a file holds a small range of every id. The least and largest id
of every file are kept in a table, and a reader with a condition on an id
opens only the files whose range can hold it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IDS = ["job_id", "run_id", "child_task_run_id"]
#: Bits of a bucket's number: 2^BITS buckets for each id.
BITS = 6


def cut_points(df: DataFrame, ids: Sequence[str], bits: int = BITS) -> list[list]:
    """For each id the 2^bits - 1 values that cut its rows into buckets of about equal size."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 100 << bits).alias(c) for c in ids]).first()
    return [sorted(set(found[c] or [])) for c in ids]


def bucket(value: Column, cuts: list) -> Column:
    """The number of cut points at or below the value, 0 for null: nested halving, so a row takes ``BITS`` steps."""
    def below(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(value >= F.lit(cuts[middle]), below(middle + 1, hi)).otherwise(below(lo, middle))
    return below(0, len(cuts))


def interleaved(buckets: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all numbers in turn, the highest first."""
    key = F.lit(0).cast("long")
    for b in range(bits):
        for k, number in enumerate(buckets):
            bit = F.shiftright(number, b).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(bit, b * len(buckets) + k))
    return key


def z_ordered(df: DataFrame, ids: Sequence[str] = IDS, files: int = 64, bits: int = BITS) -> DataFrame:
    """``df`` dealt to about ``files`` tasks by the interleaved buckets of ``ids``, sorted in each.

    A task gets one cell of the grid, the rows whose keys begin with the same bits: so its range of every id is one of
    2^(bits/ids). A cell with more rows than a file's share is cut by a hash of the ids, so a huge cell spreads over
    many writers. The cells, at most ``files``, are counted first; the counts are broadcast.
    """
    cuts = cut_points(df, ids, bits)
    z = interleaved([bucket(F.col(c), points) for c, points in zip(ids, cuts, strict=True)], bits)
    top = max(files - 1, 0).bit_length()
    rows = df.withColumn("_z", z).withColumn("_cell", F.shiftright("_z", max(bits * len(ids) - top, 0)))
    counts = {r["_cell"]: r["count"] for r in rows.groupBy("_cell").count().collect()}  # at most 2^top rows
    share = max(1, 2 * sum(counts.values()) // max(files, 1))
    cells, first = [], 0
    for cell in sorted(counts):
        parts = -(-counts[cell] // share)
        cells.append((cell, first, parts))
        first += parts
    places = df.sparkSession.createDataFrame(cells, "_cell long, _first int, _parts int")
    rows = rows.join(F.broadcast(places), "_cell").withColumn(
        "_task", F.col("_first") + F.pmod(F.xxhash64(*ids), F.col("_parts")).cast("int"))
    return rows.repartitionById(max(first, 1), F.col("_task")).sortWithinPartitions("_z", *ids).select(df.columns)


def write_z_ordered(df: DataFrame, path: str, ids: Sequence[str] = IDS, files: int = 64) -> None:
    """Write ``df`` as Parquet under ``path``/rows and the bounds of its files under ``path``/bounds."""
    z_ordered(df, ids, files).write.mode("errorifexists").parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows").select("*", F.col("_metadata.file_path").alias("file"))
    bounds = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(c).alias(f"{name}_{c}") for c in ids for f, name in ((F.min, "min"), (F.max, "max"))],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in ids])
    bounds.write.mode("errorifexists").parquet(f"{path}/bounds")


def file_bounds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/bounds")


def matching_files(spark: SparkSession, path: str, column: str, low, high) -> list[str]:
    """The files that can hold a value of ``column`` from ``low`` to ``high``: names of files, no rows."""
    hits = file_bounds(spark, path).where((F.col(f"max_{column}") >= F.lit(low)) & (F.col(f"min_{column}") <= F.lit(high)))
    return sorted(r["file"] for r in hits.select("file").collect())


def read_pruned(spark: SparkSession, path: str, column: str, low, high=None) -> DataFrame:
    """The rows whose ``column`` lies from ``low`` to ``high`` (``low`` alone if that is not given)."""
    high = low if high is None else high
    whole = spark.read.parquet(f"{path}/rows")
    files = matching_files(spark, path, column, low, high)
    rows = spark.read.schema(whole.schema).parquet(*files) if files else whole.limit(0)
    return rows.where(F.col(column).between(F.lit(low), F.lit(high)))
