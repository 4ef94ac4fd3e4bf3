"""Failure log: failed runs enriched with their landed outputs and details.

The reference loops over failed runs on the driver and calls an API per run
and per task. Here the landed answers are tables and the loop is a plan:

    runs --F1,F2--> ⟕ outputs(run level) ⟕ details      (J1, J2: keyed run_id)
         tasks of multi-task runs ⟕ outputs              (J3/J4, one equi-join)
         --> per-run error text, ordered by position     (A1: group by run_id)
         --> explode([head row] ++ child rows)           (P2..P6, U1 in one pass)

Every branch (single, multi, fallback, generic) is a column expression over
the same joined row, so the join is computed once and nothing is persisted.
Branches are exclusive; which one applies is decided from the landed HTTP
status of each call:

* ``single``   get-output answered (< 400)
* ``multi``    get-output refused with the multi-task text and details answered
* ``fallback`` multi-task refusal but no usable details
* ``generic``  any other get-output failure, or no output landed at all
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import common as C
from ..functions import runs as R
from ..schemas import FAILURE_FIELDS
from ..session import prepared
from .joins import NO_KEY, latest

NO_OUTPUT = "no output landed"
NO_DETAILS = "no details landed"
STATE_FIELDS = ["life_cycle_state", "state", "result_state", "state_message", "termination_details"]


def failed_runs(runs: DataFrame) -> DataFrame:
    """keep runs whose result state is FAILED."""
    return runs.where(F.col("state.result_state") == F.lit("FAILED"))


def latest_records(runs: DataFrame) -> DataFrame:
    """One record per run id when a run was landed more than once (the one
    with the latest end, then start)."""
    return latest(runs, ["run_id"], [F.col("end_time").desc_nulls_last(), F.col("start_time").desc_nulls_last()])


def latest_answers(answers: DataFrame, keys: list[str]) -> DataFrame:
    """One landed answer per key: the latest landing; where the landing time is
    unknown or equal, an answer rather than a failed call."""
    landed = [F.col("landed_at").desc_nulls_last()] if "landed_at" in answers.columns else []
    return latest(answers, keys, [*landed, F.col("http_status").asc_nulls_last()])


def runs_in_window(runs: DataFrame, start_ms: int | None, end_ms: int | None) -> DataFrame:
    """start time in the half-open window ``[start_ms, end_ms)``.

    F3: an end before the start is rejected while building the plan.
    """
    if start_ms is not None and end_ms is not None and end_ms < start_ms:
        raise ValueError("window end must not be before its start")
    cond = F.lit(True)
    if start_ms is not None:
        cond = cond & (F.col("start_time") >= F.lit(start_ms))
    if end_ms is not None:
        cond = cond & (F.col("start_time") < F.lit(end_ms))
    if "start_date" in runs.columns:
        # landed parquet partitioned by start date: the same bounds on the
        # partition column let the scan skip whole date folders
        if start_ms is not None:
            cond = cond & (F.col("start_date") >= F.to_date(F.timestamp_millis(F.lit(start_ms))))
        if end_ms is not None:
            cond = cond & (F.col("start_date") <= F.to_date(F.timestamp_millis(F.lit(end_ms))))
    return runs.where(cond)


def _output_key(task_key: Column) -> Column:
    # Output rows are addressed by (run_id, task_key); run-level rows have no
    # key. '' stands for "no key" so the lookup is a plain equi-join.
    return F.coalesce(task_key, F.lit(""))


def reduced(answers: DataFrame, asked: DataFrame) -> DataFrame:
    """``answers`` for the run ids of ``asked`` alone, before they are ranked:
    outputs and details hold an answer for everything ever asked."""
    return answers.join(asked.select("run_id"), "run_id", "left_semi")


def enrich_runs(runs: DataFrame, outputs: DataFrame, details: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """J1 + J2: each run with its run-level output and its details, plus the
    branch it takes and the text of a failed get-output call. ``asked`` are the
    run ids to look up, where they are had more cheaply than from ``runs``."""
    asked = runs if asked is None else asked
    at_run = latest_answers(reduced(outputs.where(_output_key(F.col("task_key")) == F.lit("")).drop("task_key"), asked),
                            ["run_id"])
    out = at_run.select(
        F.col("run_id"),
        F.col("http_status").alias("_out_status"),
        F.col("response_text").alias("_out_text"),
        F.col("body").alias("_out"),
    )
    det = latest_answers(reduced(details, asked), ["run_id"]).select(
        F.col("run_id"),
        F.col("http_status").alias("_det_status"),
        F.col("response_text").alias("_det_text"),
        F.col("body").alias("_det"),
    )
    j = runs.join(out, "run_id", "left").join(det, "run_id", "left")
    rid = F.col("run_id")
    landed = F.col("_out_status").isNotNull()
    call_ok = F.coalesce(F.col("_out_status") < 400, F.lit(False))
    call_err = F.when(landed, R.failed_call_text("runs/get-output", rid, F.col("_out_status"), F.col("_out_text"))
                      ).otherwise(F.lit(NO_OUTPUT))
    refused_multi = landed & ~call_ok & call_err.contains(R.MULTI_TASK_REFUSAL)
    det_ok = F.coalesce(F.col("_det_status") < 400, F.lit(False)) & F.col("_det").isNotNull()
    branch = (
        F.when(call_ok, F.lit("single"))
        .when(refused_multi & det_ok, F.lit("multi"))
        .when(refused_multi, F.lit("fallback"))
        .otherwise(F.lit("generic"))
    )
    det_err = F.when(F.col("_det_status").isNotNull(),
                     R.failed_call_text("runs/get", rid, F.col("_det_status"), F.col("_det_text"))
                     ).otherwise(F.lit(NO_DETAILS))
    return j.select(
        "*",
        branch.alias("_branch"),
        call_err.alias("_call_err"),
        det_ok.alias("_det_ok"),
        det_err.alias("_det_err"),
    )


def _task_id(t: Column) -> Column:
    # A task's own run id: `run_id`, else `task_run_id` (truthy, so 0 skips).
    return C.first_truthy(C.num_truthy(t.getField("run_id")), C.num_truthy(t.getField("task_run_id")))


def _task_label(t: Column) -> Column:
    return C.first_truthy(C.str_truthy(t.getField("task_key")), _task_id(t).cast("string"), F.lit("unknown_task"))


def task_lookups(enriched: DataFrame) -> DataFrame:
    """Each task of the multi-task runs with the output it reads: that landed
    for its own run id, else that of the parent run for its key.

    ``looked_up`` is false for a task with neither; it gets a key that no
    output has, spread by its run.
    """
    tasks = enriched.where(F.col("_branch") == F.lit("multi")).select(
        F.col("run_id").alias("parent_run_id"),
        F.posexplode(F.col("_det.tasks")).alias("pos", "t"),
    )
    t = F.col("t")
    tid = _task_id(t)
    key = C.str_truthy(t.getField("task_key"))
    return tasks.select(
        "parent_run_id", "pos",
        t.getField("task_key").alias("task_key"),
        tid.alias("task_run_id"),
        _task_label(t).alias("label"),
        (tid.isNotNull() | key.isNotNull()).alias("looked_up"),
        F.coalesce(tid, F.col("parent_run_id")).alias("at_run"),
        F.when(tid.isNotNull(), F.lit("")).otherwise(F.coalesce(key, F.lit(NO_KEY))).alias("at_key"),
    )


def task_answers(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    """J3 + J4: the tasks of :func:`task_lookups` with the answer each reads,
    one equi-join on (run, key)."""
    landed_at = ["landed_at"] if "landed_at" in outputs.columns else []
    asked = reduced(outputs, tasks.select(F.col("at_run").alias("run_id")))
    outs = latest_answers(asked.select(
        F.col("run_id").alias("at_run"),
        _output_key(F.col("task_key")).alias("at_key"),
        F.col("http_status"), F.col("response_text"), F.col("body.error").alias("error"), *landed_at,
    ), ["at_run", "at_key"]).drop(*landed_at)
    return tasks.join(outs, ["at_run", "at_key"], "left")


def task_errors(enriched: DataFrame, outputs: DataFrame) -> DataFrame:
    """J3 + J4: each task of a multi-task run with its own output and the error
    text made from it."""
    j = task_answers(task_lookups(enriched), outputs)
    looked_up = F.col("looked_up")
    failed = F.col("http_status") >= 400
    no_err = F.lit("no error field")
    text = (
        F.when(~looked_up, no_err)
        .when(F.col("http_status").isNull(), F.concat(F.lit("get-output error: "), F.lit(NO_OUTPUT)))
        .when(failed, F.concat(F.lit("get-output error: "),
                               R.failed_call_text("runs/get-output", F.col("at_run"),
                                                  F.col("http_status"), F.col("response_text"))))
        .otherwise(F.coalesce(C.str_truthy(F.col("error")), no_err))
    )
    return j.select(
        "parent_run_id", "pos", "task_key", "task_run_id", "label",
        F.when(looked_up, F.col("at_run")).alias("output_run_id"),
        F.col("http_status"),
        F.concat(F.col("label"), F.lit(": "), text).alias("task_error_text"),
    )


def task_error_text(task_errs: DataFrame) -> DataFrame:
    """A1: a run's task errors joined with '; ' in task order.

    A run's tasks are one bounded record of its details payload, so gathering
    them back per run never builds a group larger than that record; the order
    comes from the position, never from arrival.
    """
    return task_errs.groupBy(F.col("parent_run_id").alias("run_id")).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("pos", "task_error_text"))),
                lambda x: x.getField("task_error_text"),
            ),
            "; ",
        ).alias("error_text")
    )


def _pick(branch: Column, cases: dict[str, Column]) -> Column:
    out = None
    for b, v in cases.items():
        out = F.when(branch == F.lit(b), v) if out is None else out.when(branch == F.lit(b), v)
    return out


def _rows(e: DataFrame) -> DataFrame:
    """P2-P6 + U1: the head row of every run and the child rows of multi-task
    runs, built as one array per run and exploded.

    Built in stages (per-run picks, head fields, error fields, rows) so each
    expression is evaluated once and later stages refer to it by name; the
    optimizer keeps the stages apart rather than duplicate non-trivial work.
    """
    kinds = [e.schema["_out"].dataType["metadata"].dataType, e.schema["_det"].dataType]
    tasks = kinds[1]["tasks"].dataType
    has_keys = tuple("payload_keys" in kind.names for kind in (*kinds, tasks.elementType))
    for stage in _row_stages(has_keys, tasks.simpleString()):
        e = e.select(*stage)
    return e.select("r.*")


@prepared
def _row_stages(has_keys: tuple[bool, bool, bool], tasks_type: str) -> list[list]:
    """The columns of the stages of :func:`_rows`; ``has_keys`` tells whether
    output metadata, details and their tasks carry the keys of their payload."""
    br = F.col("_branch")
    md = F.col("_out.metadata")
    det = F.col("_det")
    is_single = br == F.lit("single")
    is_multi = br == F.lit("multi")

    # Stage 1: the output's state (state, else status, when non-empty) and
    # the times and names each branch reads.
    st = C.first_truthy(C.struct_truthy(md.getField("state"), STATE_FIELDS),
                        C.struct_truthy(md.getField("status"), STATE_FIELDS))
    s1 = [
        "run_id", "job_id", "run_name", "run_page_url", "state", "attempt_number", "run_attempt",
        "original_attempt_run_id", "_branch", "_det_ok", "_call_err", "_det_err", "_task_text",
        F.col("start_time").alias("run_start_time"),
        md.alias("_md"), det.alias("_det"), F.col("_out.error").alias("_out_error"), st.alias("_st"),
        F.when(is_single, C.first_truthy(C.num_truthy(md.getField("start_time")), F.col("start_time")))
        .otherwise(F.col("start_time")).alias("_start"),
        F.when(is_single, C.first_truthy(C.num_truthy(md.getField("end_time")), F.col("end_time")))
        .otherwise(F.col("end_time")).alias("_end"),
        C.first_truthy(C.str_truthy(md.getField("run_name")), F.col("run_name")).alias("_single_run_name"),
        # attempt / original-id candidates, each parsed once
        C.lenient_int(md.getField("attempt_number")).alias("_a_md"),
        C.lenient_int(det.getField("attempt_number")).alias("_a_det"),
        C.lenient_int(F.col("attempt_number")).alias("_a_run"),
        C.lenient_int(F.col("run_attempt")).alias("_a_run2"),
        C.lenient_int(det.getField("original_attempt_run_id")).alias("_o_det"),
        C.lenient_int(F.col("original_attempt_run_id")).alias("_o_run"),
    ]

    md, det, st = F.col("_md"), F.col("_det"), F.col("_st")
    term = st.getField("termination_details")
    run_state = F.col("state")
    rid = F.col("run_id")
    a_md, a_det, o_det = F.col("_a_md"), F.col("_a_det"), F.col("_o_det")
    a_run = [F.col("_a_run"), F.col("_a_run2")]
    o_run = [F.col("_o_run")]
    no_job = F.lit(-1).cast("bigint")

    output_error = _pick(br, {
        "single": F.col("_out_error"),
        "multi": F.coalesce(F.col("_task_text"), F.col("_call_err")),
        "fallback": F.concat(F.lit("get-output multi-task fallback failed: "), F.col("_det_err")),
        "generic": F.concat(F.lit("get-output error: "), F.col("_call_err")),
    })
    head = {
        "job_id": _pick(br, {
            "single": C.first_truthy(C.num_truthy(md.getField("job_id")), C.num_truthy(F.col("job_id")), no_job),
            "multi": C.first_truthy(C.num_truthy(det.getField("job_id")), C.num_truthy(F.col("job_id")), no_job),
            "fallback": C.first_truthy(C.num_truthy(F.col("job_id")), no_job),
            "generic": C.first_truthy(C.num_truthy(F.col("job_id")), no_job),
        }),
        "run_id": rid,
        "job_name": _pick(br, {
            "single": C.first_truthy(C.str_truthy(md.getField("job_name")), F.col("_single_run_name")),
            "multi": C.first_truthy(C.str_truthy(det.getField("job_name")), F.col("run_name")),
            "fallback": F.col("run_name"),
            "generic": C.first_truthy(F.when(F.col("_det_ok"), C.str_truthy(det.getField("job_name"))),
                                      F.col("run_name")),
        }),
        "run_name": F.when(is_single, F.col("_single_run_name")).otherwise(F.col("run_name")),
        "run_page_url": F.when(is_single, C.first_truthy(C.str_truthy(md.getField("run_page_url")),
                                                         F.col("run_page_url"))).otherwise(F.col("run_page_url")),
        "child_task_run_id": F.lit(None),
        "child_task_key": F.lit(None),
        "task_type": _pick(br, {
            "single": R.infer_task_type(R.present_kinds(md, keys=has_keys[0]), md.getField("task")),
            "multi": F.lit("multi_task_run"),
            "fallback": F.lit(None),
            "generic": F.when(F.col("_det_ok"), R.infer_task_type(R.present_kinds(det, keys=has_keys[1]),
                                                                      det.getField("task"))),
        }),
        "job_start_datetime_iso": C.iso_utc(F.col("_start")),
        "job_end_datetime_iso": C.iso_utc(F.col("_end")),
        "duration_ms": C.duration_ms(F.col("_start"), F.col("_end")),
        "life_cycle_state": F.when(is_single, C.first_truthy(C.str_truthy(st.getField("life_cycle_state")),
                                                             st.getField("state"))
                                   ).otherwise(run_state.getField("life_cycle_state")),
        "result_state": F.when(is_single, st.getField("result_state")).otherwise(run_state.getField("result_state")),
        "state_message": F.when(is_single, st.getField("state_message")).otherwise(run_state.getField("state_message")),
        "termination_code": F.when(is_single, term.getField("code")),
        "termination_type": F.when(is_single, term.getField("type")),
        "termination_reason": F.when(is_single, term.getField("reason")),
        "output_error": output_error,
        "is_retry": _pick(br, {
            "single": R.is_retry_of([a_md] + a_run, o_run, rid),
            "multi": R.is_retry_of([a_det] + a_run, [o_det] + o_run, rid),
            "fallback": R.is_retry_of(a_run, o_run, rid),
            "generic": R.is_retry_of(a_run, o_run, rid),
        }),
        "attempt_number": _pick(br, {
            "single": F.coalesce(a_md, *a_run),
            "multi": F.coalesce(a_det, *a_run),
            "fallback": F.coalesce(*a_run),
            "generic": F.coalesce(*a_run),
        }),
        "original_attempt_run_id": F.when(is_multi, F.coalesce(o_det, *o_run)).otherwise(F.coalesce(*o_run)),
    }
    names = [n for n, _ in FAILURE_FIELDS]
    typed = dict(FAILURE_FIELDS)
    error_fields = ["error_category", "error_provider", "error_message_short"]

    # Stage 2: head-row fields by name, plus the cleaned text the error
    # fields read.
    s2 = [
        "_branch", "_det", "run_start_time",
        *[head[n].cast(typed[n]).alias(n) for n in names if n not in error_fields],
        err_basis_expr(is_single, st, output_error).alias("_err"),
    ]

    # Stage 3: error fields from the cleaned text (computed once).
    err = F.col("_err")
    up = F.upper(err)
    s3 = [
        F.col("*"),
        R.category_of_upper(up).alias("error_category"),
        R.provider_of_upper(up).alias("error_provider"),
        F.substring(err, 1, R.SHORT_ERROR_CHARS).alias("error_message_short"),
    ]

    # Stage 4: [head] ++ children for multi-task runs, exploded.
    blank_for_child = {"termination_code", "termination_type", "termination_reason", "output_error",
                       *error_fields}
    head_struct = F.struct(*[F.col(n).alias(n) for n in names],
                           F.when(is_multi, F.lit("multi_summary")).otherwise(br).alias("row_kind"),
                           F.col("run_start_time"))

    def child(t: Column) -> Column:
        over = {
            "child_task_run_id": _task_id(t),
            "child_task_key": t.getField("task_key"),
            "task_type": R.infer_task_type(R.present_kinds(t, keys=has_keys[2]), t.getField("task")),
        }
        fields = []
        for n in names:
            v = over.get(n, F.lit(None) if n in blank_for_child else F.col(n))
            fields.append(v.cast(typed[n]).alias(n))
        return F.struct(*fields, F.lit("multi_task").alias("row_kind"), F.col("run_start_time"))

    no_tasks = F.array().cast(tasks_type)
    tasks = F.when(is_multi, F.coalesce(det.getField("tasks"), no_tasks)).otherwise(no_tasks)
    rows = F.concat(F.array(head_struct), F.transform(tasks, child))
    return [s1, s2, s3, [F.explode(rows).alias("r")]]


def err_basis_expr(is_single: Column, st: Column, output_error: Column) -> Column:
    """Text the error fields are derived from, cleaned once: the output's
    error (else the state message) for answered runs, the row's error text
    otherwise."""
    single = C.first_truthy(C.str_truthy(F.col("_out_error")), st.getField("state_message"))
    return R.clean_error(F.when(is_single, single).otherwise(output_error))


def failure_rows(runs: DataFrame, outputs: DataFrame, details: DataFrame, *,
                 window: tuple[int | None, int | None] | None = None,
                 keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """All failure rows with a ``row_kind`` column naming the branch and the
    ``run_start_time`` of the run each row came from.

    ``runs`` are landed run records (page entries), ``outputs`` and
    ``details`` the landed API answers (schemas in ``runlens.schemas``).

    The enriched runs are read for the rows and for the lookups of tasks, which
    Spark plans apart: it enriches up to four times. ``keep`` (such as
    ``session.stored``) holds them, so that it is done once.
    """
    r = failed_runs(runs)
    if window is not None:
        r = runs_in_window(r, *window)
    e = enrich_runs(latest_records(r), outputs, details, asked=r)
    if keep is not None:
        e = keep(e, "enriched")
    texts = task_error_text(task_errors(e, outputs)).withColumnRenamed("error_text", "_task_text")
    e = e.join(texts, "run_id", "left")
    return _rows(e)


def failure_log(runs: DataFrame, outputs: DataFrame, details: DataFrame, *, ingest_iso: str,
                window: tuple[int | None, int | None] | None = None,
                keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """P1 + P8 + P9: the typed 25-column failure log."""
    rows = failure_rows(runs, outputs, details, window=window, keep=keep)
    return rows.select(
        *[F.col(n).cast(t).alias(n) for n, t in FAILURE_FIELDS],
        F.lit(ingest_iso).alias("row_added_at"),
    )


def awaits_a_part() -> Column:
    """True for a log row whose text says that a part had not landed: the run's
    output, its details, or the output of any of its tasks."""
    text = F.col("output_error")
    missing = F.lit(f"get-output error: {NO_OUTPUT}")
    head = (text == missing) | (text == F.lit(f"get-output multi-task fallback failed: {NO_DETAILS}"))
    task = (F.col("task_type") == F.lit("multi_task_run")) & text.contains(F.concat(F.lit(": "), missing))
    return F.coalesce(head | task, F.lit(False))


def rows_of_kind(rows: DataFrame, kind: str) -> DataFrame:
    return rows.where(F.col("row_kind") == F.lit(kind)).drop("row_kind", "run_start_time")


# Fixed value: characters of the state text that the reference stores.
DEBUG_STATE_CHARS = 4000


def debug_rows(runs: DataFrame, *, host: str | None, ingest_iso: str,
               max_chars: int | None = DEBUG_STATE_CHARS) -> DataFrame:
    """K6: one diagnostic row per run: ids, the whole state object as landed
    (cut to ``max_chars``; None keeps all of it), host."""
    state = F.coalesce("state_raw", F.to_json("state")) if "state_raw" in runs.columns else F.to_json("state")
    return runs.select(
        F.col("job_id").cast("bigint").alias("job_id"),
        F.col("run_id").cast("bigint").alias("run_id"),
        (state if max_chars is None else F.substring(state, 1, max_chars)).alias("state_json"),
        F.col("run_name"), F.col("run_page_url"),
        F.lit(host).cast("string").alias("workspace_host"),
        F.lit(ingest_iso).alias("ingest_iso"),
    )


def event_key(df: DataFrame, kind: str = "event") -> Column:
    """T3 keys of single rows: 'event' is the run's or task's own id, 'attempt'
    links retries to their first attempt. Task rows without an id share the
    'event' key of their run; :func:`dedup_runs` keeps them all."""
    if kind == "attempt":
        return F.coalesce(F.col("original_attempt_run_id"), F.col("run_id"))
    return F.coalesce(F.col("child_task_run_id"), F.col("run_id"))


def dedup_latest(df: DataFrame, key: Column, order_col: str = "row_added_at") -> DataFrame:
    """Latest row per key; ties broken by the remaining columns.

    A grouped ``max`` over a struct (order column first) instead of a ranking
    window: partial aggregation collapses each key map-side, so a key holding
    a large share of the rows never lands whole in one task.
    """
    cols = [order_col] + [c for c in df.columns if c != order_col]
    best = df.groupBy(key.alias("_key")).agg(F.max(F.struct(*cols)).alias("_r"))
    return best.select(*[F.col("_r").getField(c).alias(c) for c in df.columns])


def dedup_runs(df: DataFrame, order_col: str = "row_added_at") -> DataFrame:
    """T3 without loss: of each run the rows of its latest ingest, all of them
    (summary, tasks with and without an id). One aggregate of narrow rows and
    a join on the run."""
    newest = df.groupBy("run_id").agg(F.max(order_col).alias(order_col))
    return df.join(newest, ["run_id", order_col], "left_semi")


def new_only(df: DataFrame, existing: DataFrame, key: Column) -> DataFrame:
    """Rows whose key is not yet in ``existing`` (left anti join)."""
    left = df.withColumn("_key", key)
    right = existing.select(key.alias("_key")).where(F.col("_key").isNotNull())
    return left.join(right, "_key", "left_anti").drop("_key")
