"""Incremental failure-log ingest: scheduled batch (R1-R3) and stream.

The log is partitioned by the date its runs started. Batch: resolve the
window from the watermark, build the log for runs that started in it, and
replace all rows of these runs together (an upsert by run, which rewrites the
touched dates only), then persist the new watermark.

So a run that is logged before its output has landed ("no output landed") is
corrected by a later ingest whose window, with its lookback, still covers it.

Stream: landed run pages are a file source; each micro-batch is enriched
with the outputs and details landed so far and upserted the same way, along
with the runs of earlier pages that still wait for their output. The stream's
checkpoint, kept in the shared checkpoint folder, is the high-water mark.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import failures as FL
from ..schemas import FAILURE_FIELDS, FAILURE_LOG_FIELDS, RUN_PAGE
from ..session import checkpoint_dir, cut_lineage
from ..sinks.tables import align_to, ensure_table, table_exists
from ..sources.landed import read_run_pages, runs_of_pages
from ..sources.pages import COMPLETE
from .coverage import resolve_windows, uncovered_windows, write_covered
from .watermark import DEFAULT_LOOKBACK, STATE_ID, Window, resolve_window, write_watermark


RUN_DATE = "run_date"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def dated_log(runs: DataFrame, outputs: DataFrame, details: DataFrame, *, ingest_iso: str,
              window: tuple[int | None, int | None] | None = None) -> DataFrame:
    """The failure log with the date its runs started, the log table's partition."""
    rows = FL.failure_rows(runs, outputs, details, window=window)
    return rows.select(*[F.col(n).cast(t).alias(n) for n, t in FAILURE_FIELDS], F.lit(ingest_iso).alias("row_added_at"),
                       F.to_date(F.timestamp_millis("run_start_time")).alias(RUN_DATE))


def upsert_runs(log: DataFrame, log_table: str) -> None:
    """Replace the rows of the runs in ``log``, all rows of a run together.

    Only the partitions of the dates in ``log`` are read (a run's start does
    not change, so its earlier rows are there) and written anew; dynamic
    overwrite swaps them in after the job has succeeded.
    """
    spark = log.sparkSession
    ensure_table(spark, log_table, [*FAILURE_LOG_FIELDS, (RUN_DATE, "date")], partition_by=[RUN_DATE])
    spark.catalog.refreshTable(log_table)
    fresh = cut_lineage(log)
    days = [r[0] for r in fresh.select(RUN_DATE).distinct().collect()]  # the days of one window
    if not days:
        return
    there = spark.table(log_table).where(F.col(RUN_DATE).isin([d for d in days if d]) | (
        F.col(RUN_DATE).isNull() if None in days else F.lit(False)))
    kept = there.join(fresh.select("run_id").distinct(), "run_id", "left_anti")
    merged = align_to(kept.unionByName(fresh), spark.table(log_table).schema)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")  # insertInto takes the mode from the session alone
    try:
        merged.write.insertInto(log_table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def ingest_batch(spark: SparkSession, runs: DataFrame, outputs: DataFrame, details: DataFrame, *,
                 log_table: str, state_table: str | None = None, start: str | None = None,
                 end: str | None = None, now: datetime | None = None,
                 lookback: timedelta = DEFAULT_LOOKBACK, ingest_iso: str | None = None,
                 chains: DataFrame | None = None) -> int:
    """One scheduled run. Returns the window end (epoch ms) that was stored.

    With ``chains`` (``sources.pages.page_chains``) the watermark stops where
    the complete listings from the window's start on end; the next run begins
    there (less its lookback).
    """
    now = now or datetime.now(timezone.utc)
    w = resolve_window(spark, start=start, end=end, state_table=state_table, log_table=log_table,
                       now=now, lookback=lookback)
    ingest_iso = ingest_iso or now.isoformat()
    upsert_runs(dated_log(runs, outputs, details, ingest_iso=ingest_iso, window=(w.start_ms, w.end_ms)), log_table)
    if chains is not None:
        whole = complete_parts(spark, w, chains)
        w = Window(w.start_ms, whole[0].end_ms if whole and whole[0].start_ms == w.start_ms else w.start_ms)
    if state_table:
        write_watermark(spark, state_table, w.end_iso, now.isoformat())
    return w.end_ms


def ingest_uncovered(spark: SparkSession, runs: DataFrame, outputs: DataFrame, details: DataFrame, *,
                     log_table: str, coverage_table: str, chains: DataFrame | None = None, start: str | None = None,
                     end: str | None = None, now: datetime | None = None, lookback: timedelta = timedelta(0),
                     state_id: str = STATE_ID) -> list[Window]:
    """One scheduled run by covered intervals: every uncovered window between
    ``start`` and ``end`` is ingested and then recorded, one by one, so a window
    that fails stays uncovered and the next run takes it up.

    With ``chains`` (``sources.pages.page_chains``) only what lies in complete
    listings is recorded: the runs that have landed of a broken one are logged,
    and its window is looked at again. Returns the windows recorded.
    """
    now = now or datetime.now(timezone.utc)
    done: list[Window] = []
    for w in resolve_windows(spark, coverage_table, start=start, end=end, now=now, lookback=lookback, state_id=state_id):
        upsert_runs(dated_log(runs, outputs, details, ingest_iso=now.isoformat(), window=(w.start_ms, w.end_ms)), log_table)
        whole = complete_parts(spark, w, chains) if chains is not None else [w]
        if whole:
            write_covered(spark, coverage_table, whole, now.isoformat(), state_id)
        done += whole
    return done


def complete_parts(spark: SparkSession, window: Window, chains: DataFrame) -> list[Window]:
    """The parts of a window that complete listings cover, in order. A listing
    without bounds covers all of it."""
    horizon = spark.createDataFrame([("w", window.start_ms, window.end_ms)], "id string, from_ms long, to_ms long")
    whole = chains.where(F.col("verdict") == COMPLETE).select(
        F.lit("w").alias("id"), F.coalesce("start_time_from", F.lit(window.start_ms)).alias("start_ms"),
        F.coalesce("start_time_to", F.lit(window.end_ms)).alias("end_ms"))
    parts = uncovered_windows(uncovered_windows(whole, horizon), horizon)
    return [Window(r["start_ms"], r["end_ms"]) for r in parts.orderBy("start_ms").collect()]  # the parts of one window


def failure_batch_writer(outputs: Callable[[SparkSession], DataFrame],
                         details: Callable[[SparkSession], DataFrame], log_table: str,
                         ingest_iso: Callable[[], str] | None = None,
                         landed_runs: Callable[[SparkSession], DataFrame] | None = None,
                         wait: timedelta = DEFAULT_LOOKBACK):
    """``foreachBatch`` body: enrich a micro-batch of run records and upsert
    their rows. Lookups are re-read through the batch's own session so
    outputs landed since the last trigger are seen. Runs that were logged
    without some part, and started within ``wait`` before the batch's first
    run, are taken from ``landed_runs`` and logged anew. That reads the landed
    pages again; ``waiting.start_answer_stream`` keeps what waits as state."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        stamp = ingest_iso() if ingest_iso else datetime.now(timezone.utc).isoformat()
        runs = batch
        if landed_runs and table_exists(spark, log_table):
            first = batch.agg(F.min("start_time")).first()[0]
            since = F.to_date(F.timestamp_millis(F.lit(first) - wait // timedelta(milliseconds=1)))
            waiting = spark.table(log_table).where((F.col(RUN_DATE) >= since) & FL.awaits_a_part())
            known = landed_runs(spark).join(waiting.select("run_id").distinct(), "run_id", "left_semi")
            runs = batch.unionByName(known)
        upsert_runs(dated_log(runs, outputs(spark), details(spark), ingest_iso=stamp), log_table)
    return write


def start_failure_stream(spark: SparkSession, pages_dir: str, outputs: Callable[[SparkSession], DataFrame],
                         details: Callable[[SparkSession], DataFrame], log_table: str, *,
                         checkpoint: str | None = None, available_now: bool = True,
                         ingest_iso: Callable[[], str] | None = None,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Landed page files -> failure log, as a Structured Streaming query.

    The checkpoint defaults to ``<spark.checkpoint.dir>/failure-log-stream``
    (a shared folder; the run fails if none is configured).
    ``max_files_per_trigger`` bounds each micro-batch, so a backlog of
    landed pages is worked off in batches of known size (with
    ``availableNow`` all of it is still processed in one run).
    """
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/failure-log-stream"
    reader = spark.readStream.schema(RUN_PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    pages = reader.json(pages_dir)
    runs = FL.failed_runs(runs_of_pages(pages))
    w = runs.writeStream.foreachBatch(failure_batch_writer(
        outputs, details, log_table, ingest_iso, landed_runs=lambda s: read_run_pages(s, pages_dir))).option(
        "checkpointLocation", location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
