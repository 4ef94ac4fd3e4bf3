"""The high-water mark of the scheduled incremental ingest."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import iso_utc, to_epoch_ms, to_epoch_ms_strict

STATE_ID = "main"
DEFAULT_WINDOW = timedelta(hours=24)
# How far before the watermark an ingest looks again by default.
DEFAULT_LOOKBACK = timedelta(days=2)


def watermark_of(df: DataFrame, column: str) -> DataFrame:
    """A2: the latest time in a column of ISO text, compared as instants
    (text order would put 'Z' after '+00:00'). One row: ms and ISO text."""
    m = df.agg(F.max(to_epoch_ms(F.col(column))).alias("watermark_ms"))
    return m.select("watermark_ms", iso_utc(F.col("watermark_ms")).alias("watermark_iso"))


def _first_value(df: DataFrame) -> int | None:
    row = df.first()  # one aggregated row: the only data that reaches the driver
    return None if row is None else row["watermark_ms"]


def read_watermark(spark: SparkSession, state_table: str | None, log_table: str | None,
                   state_id: str = STATE_ID) -> int | None:
    """R2: last covered window end of ``state_id`` in the state table (the row
    written last), else the latest run start in the log; None when nothing is
    known.

    The reference falls back to the ingest clock of the log, which skips
    runs that started between a window's end and its ingest (deliberate
    difference D2).
    """
    cat = spark.catalog
    if state_table and cat.tableExists(state_table):
        rows = spark.table(state_table).where(F.col("id") == F.lit(state_id))
        last = F.max_by("last_run_iso", F.struct("updated_at", to_epoch_ms("last_run_iso")))
        v = _first_value(rows.agg(to_epoch_ms(last).alias("watermark_ms")))
        if v is not None:
            return v
    if log_table and cat.tableExists(log_table):
        return _first_value(watermark_of(spark.table(log_table), "job_start_datetime_iso"))
    return None


@dataclass(frozen=True)
class Window:
    start_ms: int
    end_ms: int

    @property
    def end_iso(self) -> str:
        return datetime.fromtimestamp(self.end_ms / 1000, tz=timezone.utc).isoformat()


def resolve_window(spark: SparkSession, *, start: str | None = None, end: str | None = None,
                   state_table: str | None = None, log_table: str | None = None,
                   now: datetime | None = None, lookback: timedelta = DEFAULT_LOOKBACK) -> Window:
    """Explicit start, else the stored watermark, else end - 24 h.

    ``lookback`` re-reads starts before the watermark, so that runs which
    failed, or whose answers landed, after their window was collected are
    caught (their rows are replaced downstream). It does not move an explicit
    start. F3: an end before the start raises.
    """
    now = now or datetime.now(timezone.utc)
    end_ms = to_epoch_ms_strict(end) if end else int(now.timestamp() * 1000)
    if start:
        start_ms = to_epoch_ms_strict(start)
    else:
        wm = read_watermark(spark, state_table, log_table)
        start_ms = wm - lookback // timedelta(milliseconds=1) if wm is not None else (
            end_ms - DEFAULT_WINDOW // timedelta(milliseconds=1))
    if end_ms < start_ms:
        raise ValueError("window end must not be before its start")
    return Window(start_ms, end_ms)


def write_watermark(spark: SparkSession, state_table: str, end_iso: str, updated_at: str,
                    state_id: str = STATE_ID) -> None:
    """Append the new state of ``state_id``; readers take the row
    written last. Plain file tables have no row-level DELETE, and rewriting
    the table could lose the watermark, or another id's, in a crash."""
    row = spark.createDataFrame([(state_id, end_iso, updated_at)], "id string, last_run_iso string, updated_at string")
    row.write.mode("append").saveAsTable(state_table)
