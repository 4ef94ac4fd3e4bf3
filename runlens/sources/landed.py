"""Readers for landed API answers.

The reference fetches pages and records one HTTP call at a time on the
driver. Here each answer is landed once (a JSON document per file line) and
read with an explicit schema: files are the splits, absent keys read as
null, and only the columns a plan uses are parsed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (
    CLUSTERS,
    CROSSWALK,
    DETAIL_BODY_LANDED,
    DETAIL_TASK,
    JOB,
    JOB_COST,
    JOB_RUNS,
    OUTPUT_BODY,
    RUN_DETAILS_LANDED,
    RUN_OUTPUT_LANDED,
    RUN_PAGE,
    RUN_STATE,
    WORKSPACE_OBJECTS,
)


def runs_of_pages(pages: DataFrame) -> DataFrame:
    """G1: one row per run of every page (page order is irrelevant), the state
    object whole as text (``state_raw``) and its typed fields."""
    runs = pages.select(F.explode("runs").alias("r")).select("r.*").withColumnRenamed("state", "state_raw")
    return runs.withColumn("state", F.from_json("state_raw", RUN_STATE))


def read_run_pages(spark: SparkSession, path: str) -> DataFrame:
    """Run-list pages -> run records."""
    return runs_of_pages(spark.read.schema(RUN_PAGE).json(path))


def read_run_outputs(spark: SparkSession, path: str) -> DataFrame:
    """Get-output answers keyed (run_id, task_key). The metadata's own keys
    are read from its text, so kinds with a null value are seen."""
    return outputs_of(spark.read.schema(RUN_OUTPUT_LANDED).json(path))


def outputs_of(landed: DataFrame) -> DataFrame:
    """Output answers whose ``body`` is text, typed."""
    keys = F.json_object_keys(F.get_json_object("body", "$.metadata"))
    return landed.withColumn("body", F.from_json("body", OUTPUT_BODY).withField("metadata.payload_keys", keys))


def read_run_details(spark: SparkSession, path: str) -> DataFrame:
    """S3: runs/get answers keyed run_id (tasks nested), with the keys of the
    body and of every task."""
    return details_of(spark.read.schema(RUN_DETAILS_LANDED).json(path))


def details_of(landed: DataFrame) -> DataFrame:
    """Details answers whose ``body`` is text, typed."""
    tasks = F.transform("_body.tasks", lambda t: F.from_json(t, DETAIL_TASK).withField(
        "payload_keys", F.json_object_keys(t)))
    body = (F.col("_body").withField("payload_keys", F.json_object_keys("body")).withField("tasks", tasks))
    return landed.withColumn("_body", F.from_json("body", DETAIL_BODY_LANDED)).withColumn("body", body).drop("_body")


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job definitions with expanded tasks."""
    return spark.read.schema(JOB).json(path)


def read_job_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs of jobs (for the latest run per job)."""
    return spark.read.schema(JOB_RUNS).json(path)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """S6."""
    return spark.read.schema(CLUSTERS).json(path)


def read_workspace_objects(spark: SparkSession, path: str) -> DataFrame:
    """S7."""
    return spark.read.schema(WORKSPACE_OBJECTS).json(path)


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """S9."""
    return spark.read.schema(CROSSWALK).json(path)


def read_job_cost(spark: SparkSession, path: str) -> DataFrame:
    """S9."""
    return spark.read.schema(JOB_COST).json(path)


def land_run_pages(spark: SparkSession, pages_path: str, out_path: str, *, mode: str = "append") -> None:
    """Convert landed page files once into parquet run records partitioned by
    start date, so later window filters prune whole date folders.

    Range partitioning on (start date, run id) gives each writer a contiguous
    slice: a busy day is split over several tasks instead of one.
    """
    runs = read_run_pages(spark, pages_path).withColumn(
        "start_date", F.to_date(F.timestamp_millis(F.col("start_time"))))
    (runs.repartitionByRange("start_date", "run_id")
     .write.mode(mode).partitionBy("start_date").parquet(out_path))


def read_landed_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run records written by :func:`land_run_pages` (with ``start_date``)."""
    return spark.read.parquet(path)
