"""Job-level summary of the inventory (one row per job, 42 columns).

The reference reads the whole inventory into pandas and loops over groups
on the driver. Here it is one window and two grouped aggregations, no join:

    mark the first row of each (job, task key)     -> distinct count as a sum
    group by job keys, kind of task and version    -> counters
    group by job keys                              -> merge, versions, votes

All three are dealt by job: one shuffle, of the columns that the summary reads,
or none where the input is already partitioned by job. A job's rows meet in one
task, as they did before in the one record that its tasks came in; a null id's
rows too. The only collected lists are runtime versions and language names,
small closed vocabularies.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jobs as J
from ..session import prepared

KEYS = ["job_id", "job_name", "job_tags"]
#: The columns of the inventory that the summary reads.
READ = [*KEYS, "task_key", "task_type", "cluster_type", "dbr_version", "notebook_language", "last_run_end_time"]


def pivot_names() -> list[str]:
    return ([f"task_{tt}" for tt in J.TASK_TYPES] + [f"lang_{x.lower()}" for x in J.LANGUAGES]
            + [f"compute_{ct}" for ct in J.COMPUTE_TYPES])


@prepared
def _pivots():
    out = []
    for tt in J.TASK_TYPES:
        out.append((f"task_{tt}", F.coalesce(F.col("task_type"), F.lit("other")) == F.lit(tt)))
    for lang in J.LANGUAGES:
        out.append((f"lang_{lang.lower()}", F.col("notebook_language") == F.lit(lang)))
    for ct in J.COMPUTE_TYPES:
        out.append((f"compute_{ct}", F.coalesce(F.col("cluster_type"), F.lit("unknown")) == F.lit(ct)))
    return out


def summary_columns() -> list[str]:
    fixed = [
        "job_id", "job_name", "job_tags", "num_tasks", "last_run_end_time", "ran_last_6_months",
        "job_language", "investigation_needed", "job_name_flag", "job_name_issues",
        *J.TAG_VARIANTS.keys(), "dbr_versions", "dbr_version_count", "min_dbr_version",
    ]
    return fixed + pivot_names()


def job_summary(inventory: DataFrame, as_of, only_recent: bool = False) -> DataFrame:
    """P11 over an inventory in table form (``job_tags`` as text).

    ``as_of`` (a timestamp Column or literal) fixes "now" for the six-month
    recency flag, so results are repeatable. ``only_recent`` keeps the jobs
    that flag marks 'Y'; a job's end time is the same on all its rows, so the
    others are dropped before any task is aggregated.
    """
    as_of_col = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("timestamp")
    if only_recent:
        inventory = inventory.where(J.recency_flag(F.col("last_run_end_time"), as_of_col) == F.lit("Y"))
    counted, by_job, stages = _levels()
    # Each distinct (job, task key) is marked once, where it differs from the
    # row's before: the distinct count becomes a plain sum, so no set of a
    # job's keys is built. The window is dealt by job, as the aggregates need it.
    earlier = Window.partitionBy("job_id").orderBy(*KEYS[1:], "task_key")
    again = functools.reduce(Column.__and__, [F.lag(c).over(earlier).eqNullSafe(F.col(c)) for c in (*KEYS[1:], "task_key")])
    marked = inventory.select(*READ, (F.col("task_key").isNotNull() & ~again).alias("_first"))
    out = marked.groupBy(*KEYS, *ALIKE).agg(*counted).select("*", _lang()).groupBy(*KEYS).agg(*by_job)
    for stage in stages:
        out = out.select(*stage)
    return out.withColumn("ran_last_6_months", J.recency_flag(F.col("last_run_end_time"), as_of_col)).select(
        summary_columns())


# Level 1: tasks of a job that are alike in these are one row with their number.
ALIKE = ["dbr_version", "task_type", "cluster_type", "notebook_language"]


def _lang() -> Column:
    return J.task_language(F.col("task_type"), F.col("notebook_language")).alias("lang")


@prepared
def _levels() -> tuple[list, list, list[list]]:
    version = F.col("dbr_version")
    vkey = J.version_key(version)
    pivots = _pivots()
    # Level 1, per job and kind of task: counters alone, numbers of fixed width
    # that one hash aggregation keeps in place.
    counted = [
        F.count(F.lit(1)).alias("n"),
        F.count_if("_first").alias("keys"),
        F.max("last_run_end_time").alias("end"),
    ]
    # Level 2, per job: merge the level-1 rows (one per kind of task, so the
    # collected versions and votes are a handful).
    voting = F.col("lang").isNotNull() & (F.col("lang") != F.lit(J.INVESTIGATION_MARKER))
    by_job = [
        F.sum("keys").alias("num_tasks"),
        F.sort_array(F.collect_set("dbr_version")).alias("versions"),
        F.min(F.when(vkey.isNotNull(), F.struct(vkey.getField("major").alias("major"),
                                                 vkey.getField("minor").alias("minor"),
                                                 version.alias("v")))).getField("v").alias("min_dbr_version"),
        F.max("end").alias("last_run_end_time"),
        F.bool_or(F.coalesce(F.col("task_type").isin(*J.INVESTIGATION_TYPES), F.lit(False))).alias("inv"),
        F.bool_or(F.coalesce(F.col("lang") == F.lit(J.INVESTIGATION_MARKER), F.lit(False))).alias("flagged"),
        F.sum(F.when(voting, F.col("n")).otherwise(F.lit(0))).alias("total"),
        F.collect_list(F.when(voting, F.struct("lang", "n"))).alias("votes"),
        *[F.sum(F.when(c, F.col("n")).otherwise(F.lit(0))).alias(n) for n, c in pivots],
    ]
    voted = [F.col("*"), F.sort_array(F.array_distinct(F.col("votes.lang"))).alias("pair")]
    # The largest count is asked for where there are several languages; a label
    # names its language only if it has most of the votes, so ties tell nothing.
    votes = F.transform("pair", lambda x: F.struct(F.aggregate(
        "votes", F.lit(0).cast("bigint"), lambda sofar, v: sofar + F.when(v.getField("lang") == x, v.getField("n")).otherwise(0)
    ).alias("n"), x.alias("lang")))
    topped = [F.col("*"), F.when(F.size("pair") > 1, F.array_max(votes)).otherwise(
        F.struct(F.col("total").alias("n"), F.try_element_at("pair", F.lit(1)).alias("lang"))).alias("top")]
    # Parsed tags and name issues are computed once here and read by name
    # below (each tag column and the flag would otherwise re-evaluate them).
    staged = [F.col("*"), J.parse_tags(F.col("job_tags")).alias("_tags"),
              J.job_name_issues(F.col("job_name")).alias("job_name_issues")]
    tags = F.col("_tags")
    out = [
        *KEYS,
        F.col("num_tasks").cast("bigint").alias("num_tasks"),
        "last_run_end_time",
        J.vote_label(F.size("pair"), F.col("top.lang"), F.col("top.n"), F.col("total"),
                     F.col("pair"), F.col("flagged")).alias("job_language"),
        F.when(F.col("inv"), F.lit("Y")).otherwise(F.lit("N")).alias("investigation_needed"),
        F.when(F.col("job_name_issues").isNotNull(), F.lit("Y")).otherwise(F.lit("N")).alias("job_name_flag"),
        "job_name_issues",
        *[J.extract_tag(tags, v).alias(c) for c, v in J.TAG_VARIANTS.items()],
        F.nullif(F.array_join(F.col("versions"), ", "), F.lit("")).alias("dbr_versions"),
        F.size("versions").cast("bigint").alias("dbr_version_count"),
        "min_dbr_version",
        *[F.col(n).cast("bigint").alias(n) for n, _ in pivots],
    ]
    return counted, by_job, [voted, topped, staged, out]


def job_language(summary: DataFrame) -> DataFrame:
    return summary.select("job_id", "job_name", "job_language")


def job_pivots(summary: DataFrame) -> DataFrame:
    return summary.select("job_id", *pivot_names())
