"""R4 with late answers: runs wait for the parts of theirs that have not landed.

The client asks for a failed run's output, its details and the outputs of its
tasks as it goes. Landed, these parts come in any order and at any time. One
stream reads the new files of all three kinds; no micro-batch reads old pages
or old answers. What later batches need is kept as state, two tables in the
shared folder:

* ``waiting``  failed runs that were logged without some part: the record as
  landed, and the keys of the awaited parts (run's output, details, a task's
  output);
* ``answers``  the landed answers that waiting runs have used, and those that
  nobody has asked for yet (a part may land before its run).

A micro-batch takes the new failed runs and the waiting runs for which an
awaited part has come, builds all their rows anew from the kept and new
answers, appends them to the log as one version (``sinks.versions``) and
writes the next state. A run that awaits nothing more leaves, with its
answers. What has waited longer than ``expiry`` leaves too; its last rows
stay in the log.

The state of batch n is written to slot n mod 2 and read from the other, and
a version that is written again replaces itself: a batch that is repeated
after a crash gives the same log and state. The state is as large as what is
open, not as what was ever landed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import failures as FL
from ..schemas import RUN, RUN_DETAILS_LANDED, RUN_OUTPUT_LANDED, RUN_PAGE
from ..session import cut_lineage, shared_dir
from ..sinks.versions import append_version
from ..sources.landed import details_of, outputs_of, runs_of_pages
from .ingest import dated_log

PAGE, OUTPUT, DETAILS = "page", "output", "details"
PART = "struct<kind:string,at_run:bigint,at_key:string>"
ANSWERS = "kind string, at_run bigint, at_key string, value string, came_ms bigint"
DEFAULT_EXPIRY = timedelta(days=7)


def awaited_parts(runs: DataFrame, outputs: DataFrame, details: DataFrame) -> DataFrame:
    """(run_id, used, awaited): the parts that the rows of each failed run are made from, as an array of PART, and
    those of them that have not landed. The output of a run that answered is all there is to it."""
    e = FL.enrich_runs(runs, outputs, details)
    part = lambda kind, run, key: F.struct(
        F.lit(kind).alias("kind"), run.cast("bigint").alias("at_run"), key.alias("at_key"))
    rid, whole = F.col("run_id"), F.lit("")
    of_run = e.select(
        rid, part(OUTPUT, rid, whole).alias("part"), F.col("_out_status").isNull().alias("missing")).unionByName(
        e.where(F.col("_branch") != "single").select(
            rid, part(DETAILS, rid, whole).alias("part"), F.col("_det_status").isNull().alias("missing")))
    of_tasks = FL.task_answers(FL.task_lookups(e).where("looked_up"), outputs).select(
        F.col("parent_run_id").alias("run_id"), part(OUTPUT, F.col("at_run"), F.col("at_key")).alias("part"),
        F.col("http_status").isNull().alias("missing"))
    # a run's parts are bounded by its own record
    return of_run.unionByName(of_tasks).groupBy("run_id").agg(
        F.collect_list("part").alias("used"), F.collect_list(F.when(F.col("missing"), F.col("part"))).alias("awaited"))


def _parsed(answers: DataFrame, kind: str) -> DataFrame:
    schema, typed = (RUN_OUTPUT_LANDED, outputs_of) if kind == OUTPUT else (RUN_DETAILS_LANDED, details_of)
    return typed(answers.where(F.col("kind") == kind).select(F.from_json("value", schema).alias("r")).select("r.*"))


def _landed_answers(batch: DataFrame, now_ms: int) -> DataFrame:
    key = F.from_json("value", "run_id bigint, task_key string")
    return batch.where(F.col("kind") != PAGE).select(
        "kind", key.getField("run_id").alias("at_run"),
        F.when(F.col("kind") == OUTPUT, F.coalesce(key.getField("task_key"), F.lit(""))).otherwise("").alias("at_key"),
        "value", F.lit(now_ms).cast("bigint").alias("came_ms")).where("at_run IS NOT NULL")


class State:
    """The two tables of open runs and answers, in two slots."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str, epoch: int) -> str:
        return f"{self.folder}/{name}/slot={epoch % 2}"

    def read(self, name: str, epoch: int, schema) -> DataFrame:
        """The table as the batch before ``epoch`` left it."""
        if epoch == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(name, epoch - 1))

    def write(self, rows: DataFrame, name: str, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(self._path(name, epoch))


def _waiting_schema() -> str:
    run = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in RUN.fields)
    return f"run struct<{run}>, used array<{PART}>, awaited array<{PART}>, since_ms bigint"


def advance(batch: DataFrame, epoch: int, *, state: State, log_table: str, now: datetime | None = None,
            ingest_iso: str | None = None, expiry: timedelta = DEFAULT_EXPIRY) -> None:
    """One micro-batch of landed lines (kind, value): log what is new or has become more complete, keep what waits."""
    spark = batch.sparkSession
    now = now or datetime.now(timezone.utc)
    now_ms = int(now.timestamp() * 1000)
    oldest = now_ms - expiry // timedelta(milliseconds=1)
    came = cut_lineage(_landed_answers(batch, now_ms))
    waiting = state.read("waiting", epoch, _waiting_schema())
    answers = state.read("answers", epoch, ANSWERS).unionByName(came)

    pages = batch.where(F.col("kind") == PAGE).select(F.from_json("value", RUN_PAGE).alias("p")).select("p.*")
    fresh = FL.failed_runs(runs_of_pages(pages)).select(*RUN.fieldNames())
    new = FL.latest_records(fresh).select(F.struct(*RUN.fieldNames()).alias("run"), F.lit(now_ms).alias("since_ms"))
    known = waiting.select(F.col("run.run_id").alias("run_id"), F.explode("awaited").alias("part")).select("run_id", "part.*")
    woken = known.join(came.select("kind", "at_run", "at_key"), ["kind", "at_run", "at_key"], "left_semi").select("run_id").distinct()
    old = waiting.select("run", "since_ms", F.col("run.run_id").alias("run_id"))
    renewed = new.select(F.col("run.run_id").alias("run_id"))
    todo = cut_lineage(new.unionByName(
        old.join(woken, "run_id", "left_semi").join(renewed, "run_id", "left_anti").select("run", "since_ms")))

    runs = todo.select("run.*")
    outputs, details = _parsed(answers, OUTPUT), _parsed(answers, DETAILS)
    log = dated_log(runs, outputs, details, ingest_iso=ingest_iso or now.isoformat())
    append_version(log, log_table, epoch)

    parts = cut_lineage(awaited_parts(runs, outputs, details))
    ids = todo.select("run", "since_ms", F.col("run.run_id").alias("run_id"))
    still = ids.join(parts.where(F.size("awaited") > 0), "run_id").select("run", "used", "awaited", "since_ms")
    untouched = waiting.join(ids.select("run_id"), waiting["run.run_id"] == ids["run_id"], "left_anti")
    left = cut_lineage(still.unionByName(untouched).where(F.col("since_ms") >= oldest))
    state.write(left, "waiting", epoch)

    key = ["kind", "at_run", "at_key"]
    needed = left.select(F.explode("used").alias("part")).select("part.*").distinct().withColumn("needed", F.lit(True))
    spent = parts.where(F.size("awaited") == 0).select(F.explode("used").alias("part")).select("part.*").distinct()
    kept = answers.join(needed, key, "left").join(spent.withColumn("spent", F.lit(True)), key, "left").where(
        "needed OR (spent IS NULL AND came_ms >= %d)" % oldest)
    state.write(kept.select("kind", "at_run", "at_key", "value", "came_ms"), "answers", epoch)


def start_answer_stream(spark: SparkSession, pages_dir: str, outputs_dir: str, details_dir: str, log_table: str, *,
                        checkpoint: str | None = None, available_now: bool = True, expiry: timedelta = DEFAULT_EXPIRY,
                        clock: Callable[[], datetime] | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The stream over the landing folders of all three kinds. Its checkpoint and state lie under
    ``spark.checkpoint.dir`` unless ``checkpoint`` names a shared folder; read the log with
    ``sinks.versions.resolved_log``."""
    location = (checkpoint or f"{shared_dir(spark).rstrip('/')}/answer-stream").rstrip("/")
    state = State(spark, f"{location}/state")

    def lines(folder: str, kind: str) -> DataFrame:
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.text(folder).select(F.lit(kind).alias("kind"), "value")

    def write(batch: DataFrame, epoch: int) -> None:
        own = State(batch.sparkSession, state.folder)
        advance(batch, epoch, state=own, log_table=log_table, now=clock() if clock else None, expiry=expiry)

    landed = lines(pages_dir, PAGE).union(lines(outputs_dir, OUTPUT)).union(lines(details_dir, DETAILS))
    w = landed.writeStream.foreachBatch(write).option("checkpointLocation", f"{location}/offsets")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
