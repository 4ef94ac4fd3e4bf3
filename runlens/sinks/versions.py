"""The failure log as run versions, merged on read.

An ingest never rewrites a date. It appends the rows of its runs as one
version, and a run that has to go as a delete mark; readers take each run's
newest version whole. A run's start does not change, so all its versions lie
in the folder of its date, and a reader of some dates opens only these.

The table is partitioned by run date and part: ``v<version>`` holds what an
ingest appended, ``c<version>`` what a compaction made of all versions up to
that one. An ingest that is repeated after a crash writes its own parts anew
and nothing else. A compaction takes only the dates with more versions than
a bound; its parts count from the moment its mark is appended to the table
``<log>_compactions``. Until then readers see the versions, after it the
compacted rows, and both give the same answer; the parts that it made
obsolete are dropped last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FAILURE_LOG_FIELDS
from .tables import align_to, ensure_table, table_exists

RUN_DATE = "run_date"
VERSION_FIELDS = [*FAILURE_LOG_FIELDS, ("version", "bigint"), ("deleted", "boolean"), (RUN_DATE, "date"), ("part", "string")]
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def newest_versions(rows: DataFrame) -> DataFrame:
    """Of every run the rows of its newest version, all of them; none where that version is a delete mark.

    Only (date, run, version) meet in the aggregate; the rows are filtered by a semi-join. Runs without an id are
    one group of their date.
    """
    key = [c for c in (RUN_DATE, "run_id") if c in rows.columns]
    newest = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.max("version").alias("_version"))
    same = F.col("version") == F.col("_version")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(newest, same, "left_semi").where(~F.coalesce("deleted", F.lit(False)))


def _compactions(log_table: str) -> str:
    return f"{log_table}_compactions"


def _write_parts(rows: DataFrame, log_table: str) -> None:
    """Write whole parts: those that ``rows`` has are replaced, no other is touched."""
    spark = rows.sparkSession
    ensure_table(spark, log_table, VERSION_FIELDS, partition_by=[RUN_DATE, "part"])
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")  # insertInto takes the mode from the session alone
    try:
        align_to(rows, spark.table(log_table).schema).write.insertInto(log_table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def append_version(log: DataFrame, log_table: str, version: int, deleted: DataFrame | None = None) -> None:
    """Append the rows of ``log`` (with ``run_date``) as ``version``, and delete marks for the runs of ``deleted``
    (run_id, run_date). Versions grow; one that is written again replaces itself."""
    rows = log.withColumn("deleted", F.lit(False))
    if deleted is not None:
        rows = rows.unionByName(deleted.select("run_id", RUN_DATE, F.lit(True).alias("deleted")), allowMissingColumns=True)
    _write_parts(rows.withColumn("version", F.lit(version).cast("long")).withColumn("part", F.lit(f"v{version}")), log_table)


def live_rows(spark: SparkSession, log_table: str, since=None, until=None) -> DataFrame:
    """The parts that count, of the dates from ``since`` to ``until`` (both inclusive): a date's last compaction and
    the versions after it."""
    rows = spark.table(log_table)
    for bound, keep in ((since, lambda b: F.col(RUN_DATE) >= b), (until, lambda b: F.col(RUN_DATE) <= b)):
        if bound is not None:
            rows = rows.where(keep(F.lit(bound).cast("date")))
    if not table_exists(spark, _compactions(log_table)):
        return rows.where(F.col("part").startswith("v"))
    marks = spark.table(_compactions(log_table)).groupBy(F.col(RUN_DATE).alias("_date")).agg(F.max("upto").alias("_upto"))
    known = rows.join(marks, F.col(RUN_DATE).eqNullSafe(F.col("_date")), "left")
    compacted = F.col("part") == F.concat(F.lit("c"), F.col("_upto").cast("string"))
    after = F.col("part").startswith("v") & (F.col("version") > F.coalesce("_upto", F.lit(-1)))
    return known.where(F.coalesce(compacted, F.lit(False)) | after).drop("_date", "_upto")


def resolved_log(spark: SparkSession, log_table: str, since=None, until=None) -> DataFrame:
    """The log's rows: each run's newest version, of the dates from ``since`` to ``until``."""
    rows = newest_versions(live_rows(spark, log_table, since, until))
    return rows.select(*[n for n, _ in FAILURE_LOG_FIELDS], RUN_DATE)


def compact(spark: SparkSession, log_table: str, max_versions: int = 8) -> list:
    """Compact the dates with more than ``max_versions`` live parts; returns them. Deleted runs leave for good."""
    spark.catalog.refreshTable(log_table)
    live = live_rows(spark, log_table)
    busy = live.groupBy(RUN_DATE).agg(F.count_distinct("part").alias("n"), F.max("version").alias("upto")).where(
        F.col("n") > max_versions)
    dates = {r[RUN_DATE]: r["upto"] for r in busy.collect()}  # dates, not rows
    for upto in sorted(set(dates.values())):
        of_upto = [d for d, u in dates.items() if u == upto]
        rows = newest_versions(_of_dates(live, of_upto))
        _write_parts(rows.withColumn("part", F.lit(f"c{upto}")), log_table)
        mark_compacted(spark, log_table, of_upto, upto)
    for date, upto in dates.items():
        _drop_obsolete(spark, log_table, date, upto)
    return sorted(dates, key=str)


def _of_dates(rows: DataFrame, dates: list) -> DataFrame:
    named = [d for d in dates if d is not None]
    return rows.where(F.col(RUN_DATE).isin(named) | (F.col(RUN_DATE).isNull() if None in dates else F.lit(False)))


def mark_compacted(spark: SparkSession, log_table: str, dates: list, upto: int) -> None:
    """The commit of a compaction: one appended file."""
    marks = spark.createDataFrame([(d, upto) for d in dates], f"{RUN_DATE} date, upto long")
    marks.coalesce(1).write.mode("append").saveAsTable(_compactions(log_table))


def _drop_obsolete(spark: SparkSession, log_table: str, date, upto: int) -> None:
    if date is None:
        return  # rows without a date are few; their parts stay
    for r in spark.sql(f"SHOW PARTITIONS {log_table} PARTITION ({RUN_DATE} = DATE'{date}')").collect():
        part = r["partition"].split("part=")[1]
        if part != f"c{upto}" and int(part[1:]) <= upto:
            spark.sql(f"ALTER TABLE {log_table} DROP PARTITION ({RUN_DATE} = DATE'{date}', part = '{part}')")
