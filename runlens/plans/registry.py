"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL).

Every builder reads the driver tables under ``sf_dir`` through the fixture
projections and runs the library operators over their whole extent.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import failures as FL
from ..sources import fixtures as X
from . import oracle as O

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _landed(spark: SparkSession, d: str):
    return X.run_records(spark, d), X.run_outputs(spark, d), X.run_details(spark, d)


def failure_rows(spark: SparkSession, d: str) -> DataFrame:
    return FL.failure_rows(*_landed(spark, d))


@register("failure_log", O.failure_log_sql())
def q_failure_log(spark: SparkSession, d: str) -> DataFrame:
    return FL.failure_log(*_landed(spark, d), ingest_iso=X.INGEST_ISO)


for _name, _kind in [
    ("single_task_rows", "single"),
    ("multi_summary_rows", "multi_summary"),
    ("multi_task_rows", "multi_task"),
    ("fallback_rows", "fallback"),
    ("generic_error_rows", "generic"),
]:
    register(_name, O.rows_of_kind_sql(_kind))(
        lambda spark, d, _kind=_kind: FL.rows_of_kind(failure_rows(spark, d), _kind)
    )


# ------------------------------------------------------------------ job side
from pyspark.sql import functions as F  # noqa: E402

from ..operators import inventory as INV  # noqa: E402
from ..operators import ownership as OWN  # noqa: E402
from ..operators import refresh as REF  # noqa: E402
from ..operators import summary as SUM  # noqa: E402
from ..session import cut_lineage, shared_dir, stored  # noqa: E402
from ..sinks import zorder as Z  # noqa: E402


def inventory(spark: SparkSession, d: str, tags_as_text: bool = False, keep=None) -> DataFrame:
    return INV.job_inventory(X.jobs(spark, d), X.clusters(spark, d), X.workspace_objects(spark, d),
                             X.job_runs(spark, d), tags_as_text, keep)


def inventory_table(spark: SparkSession, d: str, keep=None) -> DataFrame:
    return inventory(spark, d, True, keep)


def summary(spark: SparkSession, d: str) -> DataFrame:
    return SUM.job_summary(inventory_table(spark, d), X.AS_OF)


def tracker(spark: SparkSession, d: str) -> DataFrame:
    return OWN.project_tracker(X.crosswalk(spark, d))


SUMMARY_COLS = ", ".join(SUM.summary_columns())


@register("job_inventory", O.job_sql(f"SELECT {O.INVENTORY_COLS} FROM inventory"))
def q_job_inventory(spark: SparkSession, d: str) -> DataFrame:
    return inventory_table(spark, d)


@register("job_summary", O.job_sql(f"SELECT {SUMMARY_COLS} FROM summary"))
def q_job_summary(spark: SparkSession, d: str) -> DataFrame:
    return summary(spark, d)


@register("job_language", O.job_sql("SELECT job_id, job_name, job_language FROM summary"))
def q_job_language(spark: SparkSession, d: str) -> DataFrame:
    return SUM.job_language(summary(spark, d))


@register("job_pivots", O.job_sql(f"SELECT job_id, {O._pivot_names()} FROM summary"))
def q_job_pivots(spark: SparkSession, d: str) -> DataFrame:
    return SUM.job_pivots(summary(spark, d))


@register("inventory_counts", O.job_sql(
    "SELECT CAST(count(*) AS BIGINT) AS task_rows, CAST(count(DISTINCT job_id) AS BIGINT) AS jobs FROM inventory"))
def q_inventory_counts(spark: SparkSession, d: str) -> DataFrame:
    return INV.inventory_counts(inventory(spark, d))


@register("last_run", O.job_sql(
    "SELECT job_id, last_run_duration_seconds, last_run_status, last_run_end_time FROM last_run"))
def q_last_run(spark: SparkSession, d: str) -> DataFrame:
    return INV.last_runs(X.job_runs(spark, d))


@register("dbr_version", O.job_sql(
    "SELECT job_id, task_key, cluster_type, dbr_version FROM inventory WHERE task_key IS NOT NULL"))
def q_dbr_version(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d).where(F.col("task_key").isNotNull()).select(
        "job_id", "task_key", "cluster_type", "dbr_version")


@register("notebook_language", O.job_sql(
    "SELECT job_id, task_key, notebook_path, notebook_name, notebook_language FROM inventory "
    "WHERE task_type = 'notebook'"))
def q_notebook_language(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d).where(F.col("task_type") == "notebook").select(
        "job_id", "task_key", "notebook_path", "notebook_name", "notebook_language")


@register("project_tracker", O.job_sql("SELECT job_name, project_name, tower_owner, manager FROM project_tracker"))
def q_project_tracker(spark: SparkSession, d: str) -> DataFrame:
    return tracker(spark, d)


def _migration_sql(cost_key: str) -> str:
    return O.job_sql(
        f"SELECT {', '.join('s.' + c for c in SUM.summary_columns())}, c.jobid, t.project_name, t.manager, t.tower_owner "
        "FROM summary s JOIN (SELECT *, lower(trim(job_name)) AS match_key FROM project_tracker WHERE job_name <> 'null') t "
        f"ON t.match_key = lower(trim(s.job_name)) LEFT JOIN job_cost c ON c.jobid = s.{cost_key}::VARCHAR "
        "WHERE s.ran_last_6_months = 'Y' AND s.job_name <> 'null'")


def _migration(spark: SparkSession, d: str, cost_key: str) -> DataFrame:
    recent = SUM.job_summary(inventory_table(spark, d), X.AS_OF, only_recent=True)
    return OWN.migration_list(recent, tracker(spark, d), X.job_cost(spark, d), cost_key)


@register("migration_list", _migration_sql("job_id"))
def q_migration_list(spark: SparkSession, d: str) -> DataFrame:
    return _migration(spark, d, "job_id")


@register("migration_list_by_name", _migration_sql("job_name"))
def q_migration_list_by_name(spark: SparkSession, d: str) -> DataFrame:
    return _migration(spark, d, "job_name")


@register("migration_list_split", _migration_sql("job_id"))
def q_migration_list_split(spark: SparkSession, d: str) -> DataFrame:
    """The ownership view where names of more than 50 jobs or owners are split on both sides."""
    recent = stored(SUM.job_summary(inventory_table(spark, d), X.AS_OF, only_recent=True), "summary")
    return OWN.migration_list(recent, tracker(spark, d), X.job_cost(spark, d), heavy_rows=50)


@register("summary_refreshed", O.job_sql(f"SELECT {SUMMARY_COLS} FROM summary"))
def q_summary_refreshed(spark: SparkSession, d: str) -> DataFrame:
    """The job summary brought up to date from one of an earlier inventory: without every seventh job, with every
    fifth job's tasks of another kind, rows twice for every eleventh job, and jobs that are gone since."""
    now = inventory_table(spark, d, stored)
    job = F.col("job_id")
    old = now.where(job % 7 != 0).withColumn("task_type", F.when(job % 5 == 0, "sql").otherwise(F.col("task_type")))
    before = old.unionByName(now.where(job % 11 == 0)).unionByName(
        now.where(job % 13 == 0).withColumn("job_id", job + 1_000_000_000))
    return REF.refreshed_summary(SUM.job_summary(before, X.AS_OF), REF.job_digests(before), now, X.AS_OF)


@register("pruned_lookup", O.failure_sql(f"SELECT {O.FAILURE_COLS} FROM rows_all WHERE run_id = (SELECT max(run_id) FROM rows_all)"))
def q_pruned_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the log's last run, read from the files of a Z-ordered log that can hold them."""
    log = cut_lineage(failure_rows(spark, d).drop("row_kind", "run_start_time"))
    path = f"{shared_dir(spark)}/runlens-z-ordered/{uuid.uuid4().hex}"
    Z.write_z_ordered(log, path, files=32)
    last = Z.file_bounds(spark, path).agg(F.max("max_run_id")).first()[0]
    return Z.read_pruned(spark, path, "run_id", last)
