"""Job inventory: one row per task of every job definition.

The reference lists jobs, then per job calls for its latest run, per
notebook task for the notebook's language and per existing cluster for its
runtime version. Here those calls are joins:

    jobs --explode_outer(tasks)--> task rows                     (G3, P10)
         shared cluster version: filter over the job's own list  (J5, no join)
         ⟕ clusters on existing_cluster_id                       (J6, null keys spread)
         ⟕ workspace_objects on notebook_path                    (J7, null keys spread)

The latest run (J8 + T1, partial aggregation) joins the jobs before their
tasks are exploded: one row per job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import common as C
from ..functions import jobs as J
from .joins import spread_key, unique_lookup

# The columns of the inventory.
INVENTORY_COLUMNS = [
    "job_id", "job_name", "job_tags", "task_key", "task_type", "cluster_type",
    "dbr_version", "notebook_path", "notebook_name", "notebook_language",
    "last_run_duration_seconds", "last_run_status", "last_run_end_time",
]


def last_runs(job_runs: DataFrame) -> DataFrame:
    """T1 + H12 + H13: each job's most recent run (latest start, then the
    highest run id) with its duration, status and end time.

    A grouped ``max`` over (start, run id, ...) rather than a ranking window:
    partial aggregation keeps one candidate per job per map task, so a job
    with a huge share of the runs never sorts whole in one task.
    """
    best = job_runs.groupBy("job_id").agg(
        F.max(F.struct("start_time", "run_id", "end_time", "state")).alias("r")
    )
    r = F.col("r")
    start, end = r.getField("start_time"), r.getField("end_time")
    st = r.getField("state")
    return best.select(
        "job_id",
        C.duration_seconds_1dp(start, end).alias("last_run_duration_seconds"),
        C.first_truthy(C.str_truthy(st.getField("result_state")),
                       C.str_truthy(st.getField("life_cycle_state"))).alias("last_run_status"),
        F.when(end != 0, F.timestamp_millis(end)).alias("last_run_end_time"),
    )


def job_inventory(jobs: DataFrame, clusters: DataFrame, workspace_objects: DataFrame,
                  job_runs: DataFrame, tags_as_text: bool = False,
                  keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """P10: 13 inventory columns; a job without tasks gives one row whose
    task fields are null. ``job_tags`` stays a map (see :func:`as_table`), or
    with ``tags_as_text`` is made text once per job, before its tasks are rows.

    ``keep`` (:func:`runlens.session.stored`) keeps the rows before the two
    lookups and those that ask for one after them: the others take no part in
    the lookups' shuffles, and who reads the inventory many times derives it once."""
    tags = F.col("settings.tags")
    ended = ["last_run_duration_seconds", "last_run_status", "last_run_end_time"]
    tags = J.tags_text(tags) if tags_as_text else F.when(F.size(tags) > 0, tags)
    # what a task row needs of its job is taken out first: exploded beside the
    # settings, every task row would carry all tasks of its job
    of_job = jobs.select("job_id", F.col("settings.name").alias("job_name"), tags.alias("job_tags"),
                         F.col("settings.job_clusters").alias("_jcs"), F.col("settings.tasks").alias("_tasks"))
    rows = of_job.join(last_runs(job_runs), "job_id", "left").select(
        "job_id", *ended, "job_name", "job_tags", "_jcs", F.explode_outer("_tasks").alias("t"))
    t = F.col("t")
    has_task = t.isNotNull()
    ttype = F.when(has_task, J.task_type(t))
    nb_path = t.getField("notebook_task").getField("notebook_path")
    rows = rows.select(
        "job_id", "job_name", "job_tags", *ended,
        t.getField("task_key").alias("task_key"),
        ttype.alias("task_type"),
        F.when(has_task, J.cluster_type(t, ttype)).alias("cluster_type"),
        t.getField("existing_cluster_id").alias("_cluster_id"),
        J.runtime_version(t, J.shared_cluster_version(F.col("_jcs"), t.getField("job_cluster_key")),
                          F.lit(None).cast("string")).alias("_own_version"),
        C.str_truthy(t.getField("existing_cluster_id")).isNotNull().alias("_uses_existing"),
        F.when(ttype == "notebook", nb_path).alias("notebook_path"),
    )
    path = F.col("notebook_path")
    if keep is None:
        return _looked_up(rows, clusters, workspace_objects, ended)
    rows = keep(rows, "task-rows")
    asks = F.coalesce((F.col("_own_version").isNull() & F.col("_uses_existing")) | (path != ""), F.lit(False))
    others = rows.where(~asks).withColumns({"spark_version": F.lit(None).cast("string"), "language": F.lit(None).cast("string")})
    return _table(others, ended).unionByName(
        keep(_looked_up(rows.where(asks), clusters, workspace_objects, ended), "looked-up"))


def _looked_up(rows: DataFrame, clusters: DataFrame, workspace_objects: DataFrame, ended: list[str]) -> DataFrame:
    found = (
        rows.withColumns({"cluster_id": spread_key(F.col("_cluster_id"), "job_id", "task_key"),
                          "path": spread_key(F.col("notebook_path"), "job_id", "task_key")})
        .join(unique_lookup(clusters, "cluster_id", "spark_version"), "cluster_id", "left")
        .join(unique_lookup(workspace_objects, "path", "language"), "path", "left")
    )
    return _table(found, ended)


def _table(rows: DataFrame, ended: list[str]) -> DataFrame:
    """The inventory's columns of rows with the answers ``spark_version`` and ``language``."""
    path = F.col("notebook_path")
    return rows.select(
        "job_id", "job_name", "job_tags", "task_key", "task_type", "cluster_type",
        F.coalesce(F.col("_own_version"), F.when(F.col("_uses_existing"), F.col("spark_version"))).alias("dbr_version"),
        "notebook_path",
        J.notebook_name(path).alias("notebook_name"),
        F.when(path != "", F.col("language")).alias("notebook_language"),
        *ended,
    )


def as_table(inventory: DataFrame) -> DataFrame:
    """Table form: the tag map stored as JSON text (null when empty)."""
    return inventory.withColumn("job_tags", J.tags_text(F.col("job_tags")))


def inventory_counts(inventory: DataFrame) -> DataFrame:
    """Number of task rows and of distinct jobs."""
    return inventory.agg(
        F.count(F.lit(1)).alias("task_rows"),
        F.count_distinct("job_id").alias("jobs"),
    )
