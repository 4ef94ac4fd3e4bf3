"""R1-R3 as covered intervals: which time has been ingested, and which not.

One high-water mark cannot say that a window in the middle failed, or that a
backfill was done. Here every ingest appends the half-open interval it has
covered; overlapping and touching intervals are merged (gaps and islands),
and the next ingest takes the gaps that are left.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window as Over
from pyspark.sql import functions as F

from ..functions.common import to_epoch_ms_strict
from .watermark import DEFAULT_WINDOW, STATE_ID, Window

COVERED = "id string, start_ms long, end_ms long, updated_at string"


def merged_intervals(intervals: DataFrame) -> DataFrame:
    """(id, start_ms, end_ms): the intervals of each id, those that overlap or touch merged into one; empty ones and
    ones without a bound don't count. Equal starts are folded to the latest end before they meet, so an interval
    written again and again is one row."""
    folded = intervals.where("end_ms > start_ms").groupBy("id", "start_ms").agg(F.max("end_ms").alias("end_ms"))
    in_order = Over.partitionBy("id").orderBy("start_ms")
    reached = F.max("end_ms").over(in_order.rowsBetween(Over.unboundedPreceding, -1))
    begins = F.when(F.col("start_ms") <= reached, 0).otherwise(1)
    islands = folded.withColumn("begins", begins).withColumn("island", F.sum("begins").over(in_order))
    return islands.groupBy("id", "island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")).drop("island")


def uncovered_windows(intervals: DataFrame, horizons: DataFrame) -> DataFrame:
    """(id, start_ms, end_ms): the parts of each id's horizon [from_ms, to_ms) that no interval covers, as the largest
    windows. An id without intervals gets its whole horizon; one without a horizon gets nothing."""
    span = horizons.where("to_ms > from_ms").groupBy("id").agg(F.min("from_ms").alias("from_ms"), F.max("to_ms").alias("to_ms"))
    # the horizon's ends stand for intervals without length, so every gap lies between two rows
    ends = span.select("id", F.explode(F.array(
        F.struct(F.col("from_ms").alias("start_ms"), F.col("from_ms").alias("end_ms")),
        F.struct(F.col("to_ms").alias("start_ms"), F.col("to_ms").alias("end_ms")))).alias("e")).select("id", "e.*")
    inside = merged_intervals(intervals).join(span, "id").where("end_ms > from_ms AND start_ms < to_ms").select(
        "id", F.greatest("start_ms", "from_ms").alias("start_ms"), F.least("end_ms", "to_ms").alias("end_ms"))
    after = Over.partitionBy("id").orderBy("start_ms", "end_ms")
    gaps = inside.unionByName(ends).withColumn("next_ms", F.lead("start_ms").over(after))
    return gaps.where("next_ms > end_ms").select("id", F.col("end_ms").alias("start_ms"), F.col("next_ms").alias("end_ms"))


def covered(spark: SparkSession, coverage_table: str) -> DataFrame:
    if spark.catalog.tableExists(coverage_table):
        return spark.table(coverage_table)
    return spark.createDataFrame([], COVERED)


def resolve_windows(spark: SparkSession, coverage_table: str, *, start: str | None = None, end: str | None = None,
                    now: datetime | None = None, lookback: timedelta = timedelta(0), state_id: str = STATE_ID) -> list[Window]:
    """The windows that an ingest has to take: the gaps between ``start`` and ``end``, in order.

    Without a ``start`` the horizon begins where coverage begins, else a day before its end. ``lookback`` gives up the
    coverage of that last stretch before the end of coverage, so that late failures are looked at again. An explicit
    ``start`` takes what is uncovered from there, which is a backfill; an end before it raises.
    """
    now = now or datetime.now(timezone.utc)
    end_ms = to_epoch_ms_strict(end) if end else int(now.timestamp() * 1000)
    mine = covered(spark, coverage_table).where(F.col("id") == state_id)
    known = mine.agg(F.min("start_ms").alias("first"), F.max("end_ms").alias("last")).first()
    ms = lambda d: d // timedelta(milliseconds=1)
    if start:
        start_ms = to_epoch_ms_strict(start)
    else:
        start_ms = min(known["first"], end_ms) if known["first"] is not None else end_ms - ms(DEFAULT_WINDOW)
    if end_ms < start_ms:
        raise ValueError("window end must not be before its start")
    if known["last"] is not None and lookback and not start:
        again = min(known["last"], end_ms) - ms(lookback)
        mine = mine.withColumn("end_ms", F.least("end_ms", F.lit(again)))
    horizon = spark.createDataFrame([(state_id, start_ms, end_ms)], "id string, from_ms long, to_ms long")
    gaps = uncovered_windows(mine, horizon).orderBy("start_ms").collect()  # the windows of one ingest
    return [Window(r["start_ms"], r["end_ms"]) for r in gaps]


def write_covered(spark: SparkSession, coverage_table: str, windows: list[Window], updated_at: str,
                  state_id: str = STATE_ID) -> None:
    """Append what an ingest has covered. Nothing is rewritten, so a crash loses at most this ingest's intervals, and
    its windows are taken up again."""
    rows = [(state_id, w.start_ms, w.end_ms, updated_at) for w in windows]
    spark.createDataFrame(rows, COVERED).coalesce(1).write.mode("append").saveAsTable(coverage_table)


def compact_covered(spark: SparkSession, coverage_table: str, into: str, updated_at: str) -> None:
    """The merged intervals as a new table; the old one stays as it is."""
    merged_intervals(covered(spark, coverage_table)).withColumn("updated_at", F.lit(updated_at)).select(
        "id", "start_ms", "end_ms", "updated_at").write.mode("errorifexists").saveAsTable(into)
