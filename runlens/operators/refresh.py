"""P11 kept up to date: only jobs whose inventory changed are summed up again.

The stored summary has beside it a digest of every job: the number of its
inventory rows and the sum of their hashes, which no order of rows changes.
A new inventory is reduced to digests by one partial aggregation; where they
differ from the stored ones the job was inserted, edited or deleted. The new
summary is the old one without these jobs, and the summary of their rows
alone: minimum version, version set and language vote can't be taken back
row by row. The pivot counters can: given the rows that left and came, they
are corrected without reading any other row of the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jobs as J
from ..session import stored
from .summary import KEYS, READ, _pivots, job_summary, pivot_names, summary_columns


def job_digests(inventory: DataFrame) -> DataFrame:
    """(job_id, n_rows, digest): digest is the exact sum of the hashes of the job's rows, of two 64-bit hashes each."""
    # a hash is summed as its two halves: sums of longs, which cost a fraction of sums of decimals
    def total(seed: int):
        high, low = F.sum(F.shiftright(f"_{seed}", 32)), F.sum(F.col(f"_{seed}").bitwiseAND(F.lit(0xFFFFFFFF)))
        return (high.cast("decimal(38,0)") * F.lit(1 << 32) + low).cast("decimal(38,0)").cast("string")
    hashed = inventory.select("job_id", *[F.xxhash64(F.lit(seed), *READ).alias(f"_{seed}") for seed in (1, 2)])
    return hashed.groupBy("job_id").agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", total(1), total(2)).alias("digest"))


def changed_jobs(before: DataFrame, after: DataFrame) -> DataFrame:
    """(job_id, change): the jobs whose digests differ, as 'inserted', 'edited' or 'deleted'."""
    # united and grouped, not joined: both sides are dealt by job already, and a null id is a group like any other
    digest, none = F.struct("n_rows", "digest"), F.lit(None).cast("struct<n_rows:bigint,digest:string>")
    sides = before.select("job_id", digest.alias("old"), none.alias("new")).unionByName(
        after.select("job_id", none.alias("old"), digest.alias("new")))
    both = sides.groupBy("job_id").agg(F.max("old").alias("old"), F.max("new").alias("new"))
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(
        "job_id", F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "deleted").otherwise("edited").alias("change"))


def refreshed_summary(previous: DataFrame, digests: DataFrame, inventory: DataFrame, as_of) -> DataFrame:
    """The summary of ``inventory``, given a ``previous`` summary and the digests of the inventory it was made from."""
    changed = stored(changed_jobs(digests, job_digests(inventory)).select(F.col("job_id").alias("_job")), "changed")
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    # Joined on the plain id, by which the summary's rows are dealt before and after the joins. A null id matches
    # nothing: rows without an id are summed up again in any case.
    same, null = F.col("job_id") == F.col("_job"), F.col("job_id").isNull()
    # the recency flag is of the day, whether or not the job changed
    kept = previous.where(~null).join(changed, same, "left_anti").withColumn(
        "ran_last_6_months", J.recency_flag(F.col("last_run_end_time"), as_of_col))
    columns = summary_columns()
    # kept for itself: the shuffles of the earlier summary are gone before those of the changed jobs' rows are written
    kept = stored(kept.select(columns), "kept")
    fresh = job_summary(inventory.join(changed, same, "left").where(F.col("_job").isNotNull() | null).drop("_job"), as_of)
    return kept.unionByName(fresh.select(columns))


def counters(inventory: DataFrame, weight: int = 1) -> DataFrame:
    """(job, n_rows, pivots) of inventory rows, each counted ``weight`` times."""
    return inventory.groupBy(*KEYS).agg((F.count(F.lit(1)) * weight).alias("n_rows"),
                                        *[(F.count_if(c) * weight).alias(n) for n, c in _pivots()])


def corrected_counters(previous: DataFrame, left: DataFrame, came: DataFrame) -> DataFrame:
    """The counters after the inventory rows of ``left`` have left and those of ``came`` have come (an edited row does
    both); jobs without a row are gone. Unchanged rows are not read."""
    names = ["n_rows", *pivot_names()]
    changes = previous.select(*KEYS, *names).unionByName(counters(left, -1)).unionByName(counters(came))
    return changes.groupBy(*KEYS).agg(*[F.sum(n).alias(n) for n in names]).where("n_rows > 0")
