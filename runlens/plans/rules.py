"""Registered queries for single operators and scalar rules.

Each applies one rule of the library to a whole driver table (or to a
projection Spark derives from it) so the rule's work grows with the data;
the SQL beside it restates the rule in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import common as C
from ..functions import jobs as J
from ..functions import runs as R
from ..operators import failures as FL
from ..operators.masking import masked_view
from ..session import stored
from ..sources import fixtures as X
from ..sinks.versions import newest_versions
from ..sources.pages import page_chains
from ..streaming.coverage import uncovered_windows
from ..streaming.watermark import watermark_of
from . import oracle as O
from .registry import inventory, register

_RUNS_WITH = f"WITH {O.RUNS_CTE}\n"
_EV = "(SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events)"


def _landed(spark, d):
    return X.run_records(spark, d), X.run_outputs(spark, d), X.run_details(spark, d)


@register("relanded_answers", O.failure_log_sql())
def q_relanded_answers(spark: SparkSession, d: str) -> DataFrame:
    """The failure log where every answer was landed twice, a failed call first: the log is the same."""
    runs, outputs, details = _landed(spark, d)

    def twice(answers: DataFrame) -> DataFrame:
        first = answers.withColumns({
            "landed_at": F.lit(1).cast("long"), "http_status": F.lit(500), "response_text": F.lit("retry"),
            "body": F.lit(None).cast(answers.schema["body"].dataType)})
        return first.unionByName(answers.withColumn("landed_at", F.lit(2).cast("long")))

    return FL.failure_log(runs.unionByName(runs), twice(outputs), twice(details), ingest_iso=X.INGEST_ISO)


# --------------------------------------------------------------- listings S1, intervals R1-R3

@register("page_chains", O.PAGE_CHAINS)
def q_page_chains(spark: SparkSession, d: str) -> DataFrame:
    return page_chains(X.run_pages(spark, d))


@register("uncovered_windows", O.UNCOVERED)
def q_uncovered_windows(spark: SparkSession, d: str) -> DataFrame:
    return uncovered_windows(X.ingested_intervals(spark, d), X.ingest_horizons(spark, d))


# --------------------------------------------------------------- filters F1 F2 F4

@register("runs_in_window", _RUNS_WITH + "SELECT run_id, job_id, start_time, result_state FROM runs "
          f"WHERE start_time >= {O.window_ms()[0]} AND start_time < {O.window_ms()[1]}")
def q_runs_in_window(spark: SparkSession, d: str) -> DataFrame:
    lo, hi = (C.to_epoch_ms_strict(x) for x in X.WINDOW)
    return FL.runs_in_window(X.run_records(spark, d), lo, hi).select(
        "run_id", "job_id", "start_time", F.col("state.result_state").alias("result_state"))


@register("failed_runs", _RUNS_WITH + "SELECT run_id, job_id, start_time, state_message FROM runs "
          "WHERE result_state = 'FAILED'")
def q_failed_runs(spark: SparkSession, d: str) -> DataFrame:
    return FL.failed_runs(X.run_records(spark, d)).select(
        "run_id", "job_id", "start_time", F.col("state.state_message").alias("state_message"))


@register("multi_task_runs", O.failure_sql(
    "SELECT run_id, call_err AS output_error, branch FROM e WHERE branch IN ('multi', 'fallback')"))
def q_multi_task_runs(spark: SparkSession, d: str) -> DataFrame:
    r, o, de = _landed(spark, d)
    e = FL.enrich_runs(FL.latest_records(FL.failed_runs(r)), o, de)
    return e.where(F.col("_branch").isin("multi", "fallback")).select(
        "run_id", F.col("_call_err").alias("output_error"), F.col("_branch").alias("branch"))


# ----------------------------------------------------------------- J3 J4 A1

@register("task_errors", O.failure_sql(
    "SELECT parent_run_id, pos, task_key, task_run_id, label, output_run_id, http_status, task_error_text FROM te2"))
def q_task_errors(spark: SparkSession, d: str) -> DataFrame:
    r, o, de = _landed(spark, d)
    return FL.task_errors(FL.enrich_runs(FL.latest_records(FL.failed_runs(r)), o, de), o)


@register("task_error_text", O.failure_sql("SELECT run_id, error_text FROM agg"))
def q_task_error_text(spark: SparkSession, d: str) -> DataFrame:
    r, o, de = _landed(spark, d)
    return FL.task_error_text(FL.task_errors(FL.enrich_runs(FL.latest_records(FL.failed_runs(r)), o, de), o))


# ------------------------------------------------------------- T3 K6 K13 A2

def _two_ingests(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lo, hi = (C.to_epoch_ms_strict(x) for x in X.WINDOW)
    landed = X.landed_once(spark, d)
    a = FL.failure_log(*landed, ingest_iso=X.INGEST_ISO, window=(lo, hi), keep=stored)
    b = FL.failure_log(*landed, ingest_iso=X.REINGEST_ISO, keep=stored)
    return a, b


@register("dedup_latest", O.dedup_latest_sql())
def q_dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    """The key of single rows, under which task rows without an id fold into their run's row."""
    both = DataFrame.unionByName(*_two_ingests(spark, d))
    return FL.dedup_latest(both, FL.event_key(both))


@register("dedup_rows", O.dedup_rows_sql())
def q_dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    return FL.dedup_runs(DataFrame.unionByName(*_two_ingests(spark, d)))


@register("resolved_log", O.dedup_rows_sql())
def q_resolved_log(spark: SparkSession, d: str) -> DataFrame:
    """The log read from run versions: the first ingest, delete marks for half of its runs, and the second ingest."""
    a, b = _two_ingests(spark, d)

    def versions(rows: DataFrame, version: int, deleted: bool) -> DataFrame:
        return rows.withColumns({"version": F.lit(version), "deleted": F.lit(deleted)})

    gone = a.where(F.col("run_id") % 2 == 0).select("run_id").distinct()
    kept = gone.join(b.select("run_id").distinct(), "run_id", "left_semi")  # the second ingest brings these back
    log = versions(a, 1, False).unionByName(versions(kept, 2, True), allowMissingColumns=True).unionByName(versions(b, 3, False))
    return newest_versions(log).select(a.columns)


@register("new_only", O.new_only_sql())
def q_new_only(spark: SparkSession, d: str) -> DataFrame:
    a, b = _two_ingests(spark, d)
    return FL.new_only(b, a, FL.event_key(b))


@register("masked_view", O.masked_sql())
def q_masked_view(spark: SparkSession, d: str) -> DataFrame:
    log = FL.failure_log(*_landed(spark, d), ingest_iso=X.INGEST_ISO)
    return masked_view(log, {"job_name": "mask", "run_page_url": "hash", "state_message": "null"})


@register("debug_rows", O.debug_rows_sql())
def q_debug_rows(spark: SparkSession, d: str) -> DataFrame:
    return FL.debug_rows(FL.failed_runs(X.run_records(spark, d)), host=O.DEBUG_HOST, ingest_iso=X.INGEST_ISO)


def _iso_texts(ts: F.Column, ix: F.Column) -> F.Column:
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return (F.when(ix % 3 == 0, F.concat(base, F.lit("Z")))
            .when(ix % 3 == 1, F.concat(base, F.lit("+00:00")))
            .otherwise(F.concat(base, F.lit("+01:00"))))


_ISO_TEXTS_SQL = ("CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' "
                  "WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' "
                  "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+01:00' END")


@register("watermark_max", f"SELECT max(epoch_us(CAST(replace(t, 'Z', '+00:00') AS TIMESTAMPTZ)) // 1000) AS watermark_ms, "
          f"{O.iso('max(epoch_us(CAST(replace(t, ' + chr(39) + 'Z' + chr(39) + ', ' + chr(39) + '+00:00' + chr(39) + ') AS TIMESTAMPTZ)) // 1000)')} "
          f"AS watermark_iso FROM (SELECT {_ISO_TEXTS_SQL} AS t FROM events)")
def q_watermark_max(spark: SparkSession, d: str) -> DataFrame:
    ev = X.table(spark, d, "events").select("event_id", "ts")
    return watermark_of(ev.select(_iso_texts(F.col("ts"), F.col("event_id")).alias("t")), "t")


# ------------------------------------------------------------ scalar rules (H)

def _kind(ix: F.Column) -> F.Column:
    out = F.lit(None).cast("string")
    for i, k in reversed(list(enumerate(R.RUN_TASK_KINDS))):
        out = F.when(ix == i, F.lit(k)).otherwise(out)
    return out


def _payloads(spark: SparkSession, d: str) -> DataFrame:
    li = X.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    a, b = _kind(F.col("l_partkey") % 9), _kind(F.col("l_suppkey") % 9)
    shape = F.col("l_linenumber") % 4
    q = F.lit('"')
    raw = (
        F.when(shape == 0, F.concat(F.lit('{"'), a, F.lit('":{},"'), b, F.lit('":null}')))
        .when(shape == 1, F.concat(F.lit('{"task":{"'), a, F.lit('":{}},"'), b, F.lit('":{}}')))
        .when(shape == 2, F.concat(F.lit('{"task":{},'), q, b, F.lit('":{}}')))
        .otherwise(F.lit('{"x_task":1,"task":[]}'))
    )
    return li.select("l_orderkey", "l_linenumber", raw.alias("payload"))


def _payloads_sql() -> str:
    a, b = O.kind_at("l_partkey % 9", R.RUN_TASK_KINDS), O.kind_at("l_suppkey % 9", R.RUN_TASK_KINDS)
    return (f"SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 "
            f"WHEN 0 THEN '{{\"' || {a} || '\":{{}},\"' || {b} || '\":null}}' "
            f"WHEN 1 THEN '{{\"task\":{{\"' || {a} || '\":{{}}}},\"' || {b} || '\":{{}}}}' "
            f"WHEN 2 THEN '{{\"task\":{{}},\"' || {b} || '\":{{}}}}' "
            f"ELSE '{{\"x_task\":1,\"task\":[]}}' END AS payload FROM lineitem")


@register("infer_task_type", f"SELECT l_orderkey, l_linenumber, payload, "
          f"{O.infer_type('json_extract(payload, ' + chr(39) + '$.task' + chr(39) + ')', 'json_keys(payload)')} AS task_type "
          f"FROM ({_payloads_sql()})")
def q_infer_task_type(spark: SparkSession, d: str) -> DataFrame:
    p = _payloads(spark, d)
    return p.select("l_orderkey", "l_linenumber", "payload",
                    R.infer_task_type(R.raw_keys("payload"), F.get_json_object("payload", "$.task")).alias("task_type"))


def _int_texts(k: F.Column, ix: F.Column) -> F.Column:
    ks = k.cast("string")
    return (F.when(ix % 6 == 0, ks).when(ix % 6 == 1, F.concat(F.lit(" "), ks, F.lit(" ")))
            .when(ix % 6 == 2, F.concat(ks, F.lit("_000"))).when(ix % 6 == 3, F.concat(ks, F.lit(".5")))
            .when(ix % 6 == 4, F.concat(F.lit("+"), ks)).otherwise(F.concat(F.lit("x"), ks)))


_INT_TEXTS_SQL = ("CASE event_id % 6 WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN ' ' || CAST(k AS VARCHAR) || ' ' "
                  "WHEN 2 THEN CAST(k AS VARCHAR) || '_000' WHEN 3 THEN CAST(k AS VARCHAR) || '.5' "
                  "WHEN 4 THEN '+' || CAST(k AS VARCHAR) ELSE 'x' || CAST(k AS VARCHAR) END")


@register("lenient_int", f"SELECT event_id, t AS text, CASE WHEN regexp_matches(t, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$') "
          f"THEN TRY_CAST(replace(trim(t), '_', '') AS BIGINT) END AS value "
          f"FROM (SELECT event_id, {_INT_TEXTS_SQL} AS t FROM {_EV})")
def q_lenient_int(spark: SparkSession, d: str) -> DataFrame:
    ev = X.table(spark, d, "events").select("event_id", "props")
    k = F.get_json_object("props", "$.k").cast("bigint")
    t = ev.select("event_id", _int_texts(k, F.col("event_id")).alias("text"))
    return t.select("event_id", "text", C.lenient_int("text").alias("value"))


def _run_retry(spark: SparkSession, d: str) -> DataFrame:
    r = X.run_records(spark, d)
    a = [F.col("attempt_number"), F.col("run_attempt")]
    o = [F.col("original_attempt_run_id")]
    return r.select(
        "run_id",
        R.is_retry(a, o, F.col("run_id")).alias("is_retry"),
        R.attempt_number(*a).alias("attempt_number"),
        R.original_attempt_run_id(*o).alias("original_attempt_run_id"),
    )


@register("is_retry", _RUNS_WITH + "SELECT run_id, coalesce(attempt_number > 0, false) OR coalesce(run_attempt > 0, false) "
          "OR coalesce(nullif(original_attempt_run_id, 0) <> run_id AND run_id <> 0, false) AS is_retry FROM runs")
def q_is_retry(spark: SparkSession, d: str) -> DataFrame:
    return _run_retry(spark, d).select("run_id", "is_retry")


@register("attempt_number", _RUNS_WITH + "SELECT run_id, coalesce(attempt_number, run_attempt) AS attempt_number FROM runs")
def q_attempt_number(spark: SparkSession, d: str) -> DataFrame:
    return _run_retry(spark, d).select("run_id", "attempt_number")


@register("original_attempt", _RUNS_WITH + "SELECT run_id, original_attempt_run_id FROM runs")
def q_original_attempt(spark: SparkSession, d: str) -> DataFrame:
    return _run_retry(spark, d).select("run_id", "original_attempt_run_id")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return X.table(spark, d, "documents").select("doc_id", "text")


@register("error_category", f"SELECT doc_id, {O.category('text')} AS error_category FROM documents")
def q_error_category(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", R.error_category("text").alias("error_category"))


@register("error_provider", f"SELECT doc_id, {O.provider('text')} AS error_provider FROM documents")
def q_error_provider(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", R.error_provider("text").alias("error_provider"))


@register("error_short", f"SELECT doc_id, {O.short('text')} AS error_message_short FROM documents")
def q_error_short(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", R.error_short("text").alias("error_message_short"))


def _time_texts(ts: F.Column, ix: F.Column) -> F.Column:
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    plain = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return (F.when(ix % 6 == 0, F.date_format(ts, "yyyy-MM-dd")).when(ix % 6 == 1, plain)
            .when(ix % 6 == 2, F.concat(base, F.lit("Z")))
            .when(ix % 6 == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(ix % 6 == 4, F.concat(base, F.lit("+02:00")))
            .otherwise(F.concat(plain, F.lit("-02:00"))))


_TIME_TEXTS_SQL = ("CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') "
                   "WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') "
                   "WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' "
                   "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || '-02:00' END")
_ISO_SHAPE_SQL = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,6})?)?)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?$'"


@register("to_epoch_ms", "SELECT event_id, t AS text, CASE "
          "WHEN contains(t, 'T') OR suffix(t, 'Z') OR contains(t, '+') THEN CASE WHEN regexp_matches(t, " + _ISO_SHAPE_SQL + ") "
          "THEN CASE WHEN regexp_matches(t, '(Z|[+-][0-9]{2}:[0-9]{2})$') "
          "THEN epoch_us(TRY_CAST(replace(t, 'Z', '+00:00') AS TIMESTAMPTZ)) // 1000 "
          "ELSE epoch_us(TRY_CAST(t AS TIMESTAMP)) // 1000 END END "
          "WHEN length(t) = 10 AND regexp_matches(t, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$') "
          "THEN epoch_us(TRY_STRPTIME(t, '%Y-%m-%d')) // 1000 "
          "WHEN regexp_matches(t, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$') "
          "THEN epoch_us(TRY_STRPTIME(t, '%Y-%m-%d %H:%M:%S')) // 1000 END AS epoch_ms "
          f"FROM (SELECT event_id, {_TIME_TEXTS_SQL} AS t FROM events)")
def q_to_epoch_ms(spark: SparkSession, d: str) -> DataFrame:
    ev = X.table(spark, d, "events").select("event_id", "ts")
    t = ev.select("event_id", _time_texts(F.col("ts"), F.col("event_id")).alias("text"))
    return t.select("event_id", "text", C.to_epoch_ms("text").alias("epoch_ms"))


@register("iso_utc", f"SELECT event_id, ms, {O.iso('ms')} AS iso FROM (SELECT event_id, CASE event_id % 3 "
          f"WHEN 0 THEN {O.ms('ts')} WHEN 1 THEN ({O.ms('ts')} // 1000) * 1000 ELSE 0 END AS ms FROM events)")
def q_iso_utc(spark: SparkSession, d: str) -> DataFrame:
    ev = X.table(spark, d, "events").select("event_id", "ts")
    m = F.unix_millis(F.col("ts").cast("timestamp"))
    ms = F.when(F.col("event_id") % 3 == 0, m).when(F.col("event_id") % 3 == 1, F.floor(m / 1000) * 1000).otherwise(0)
    t = ev.select("event_id", ms.cast("bigint").alias("ms"))
    return t.select("event_id", "ms", C.iso_utc("ms").alias("iso"))


@register("duration_ms", _RUNS_WITH + f"SELECT run_id, {O.dur('start_time', 'end_time')} AS duration_ms FROM runs")
def q_duration_ms(spark: SparkSession, d: str) -> DataFrame:
    r = X.run_records(spark, d)
    return r.select("run_id", C.duration_ms("start_time", "end_time").alias("duration_ms"))


# ---------------------------------------------------------- job-side rules

@register("task_type", O.job_sql("SELECT job_id, task_key, task_type FROM inventory"))
def q_task_type(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d).select("job_id", "task_key", "task_type")


@register("cluster_type", O.job_sql("SELECT job_id, task_key, cluster_type FROM inventory"))
def q_cluster_type(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d).select("job_id", "task_key", "cluster_type")


@register("notebook_name", O.job_sql("SELECT job_id, task_key, notebook_path, notebook_name FROM inventory "
                                     "WHERE notebook_path IS NOT NULL"))
def q_notebook_name(spark: SparkSession, d: str) -> DataFrame:
    return inventory(spark, d).where(F.col("notebook_path").isNotNull()).select(
        "job_id", "task_key", "notebook_path", "notebook_name")


@register("task_language", O.job_sql(f"SELECT job_id, task_key, task_type, notebook_language, {O._lang()} AS task_language "
                                     "FROM inventory"))
def q_task_language(spark: SparkSession, d: str) -> DataFrame:
    inv = inventory(spark, d)
    return inv.select("job_id", "task_key", "task_type", "notebook_language",
                      J.task_language(F.col("task_type"), F.col("notebook_language")).alias("task_language"))


@register("parse_version", O.job_sql(
    "SELECT job_id, task_key, dbr_version, TRY_CAST(regexp_extract(dbr_version, '^(\\d+)\\.(\\d+)', 1) AS BIGINT) AS major, "
    "TRY_CAST(regexp_extract(dbr_version, '^(\\d+)\\.(\\d+)', 2) AS BIGINT) AS minor FROM inventory "
    "WHERE dbr_version IS NOT NULL"))
def q_parse_version(spark: SparkSession, d: str) -> DataFrame:
    inv = inventory(spark, d).where(F.col("dbr_version").isNotNull())
    k = J.version_key(F.col("dbr_version"))
    return inv.select("job_id", "task_key", "dbr_version", k.getField("major").alias("major"),
                      k.getField("minor").alias("minor"))


def _jobs_tags(spark: SparkSession, d: str) -> DataFrame:
    j = X.jobs(spark, d)
    return j.select("job_id", J.tags_text(F.col("settings.tags")).alias("job_tags"))


_JOBS_SQL = f"(SELECT o_orderkey + 1 AS job_id, {O._job_names()} AS job_name, {O._tag_text()} AS job_tags FROM orders)"


@register("tags_text", f"SELECT job_id, job_tags FROM {_JOBS_SQL}")
def q_tags_text(spark: SparkSession, d: str) -> DataFrame:
    return _jobs_tags(spark, d)


@register("parse_tags", "SELECT job_id, coalesce(array_to_string(list_sort(json_keys(job_tags)), ','), '') AS tag_keys, "
          f"CAST(coalesce(len(json_keys(job_tags)), 0) AS INTEGER) AS n_tags FROM {_JOBS_SQL}")
def q_parse_tags(spark: SparkSession, d: str) -> DataFrame:
    t = _jobs_tags(spark, d)
    # even ids carry the legacy single-quoted literal form
    legacy = F.when(F.col("job_id") % 2 == 0, F.regexp_replace("job_tags", '"', "'")).otherwise(F.col("job_tags"))
    m = J.parse_tags(legacy)
    return t.select("job_id", F.array_join(F.array_sort(F.map_keys(m)), ",").alias("tag_keys"),
                    F.size(m).alias("n_tags"))


@register("extract_tag", "SELECT job_id, " + ", ".join(
    O._tag(v) + " AS " + c for c, v in J.TAG_VARIANTS.items()) + f" FROM {_JOBS_SQL}")
def q_extract_tag(spark: SparkSession, d: str) -> DataFrame:
    t = _jobs_tags(spark, d)
    m = J.parse_tags(F.col("job_tags"))
    return t.select("job_id", *[J.extract_tag(m, v).alias(c) for c, v in J.TAG_VARIANTS.items()])


def _names(spark: SparkSession, d: str) -> DataFrame:
    jobs = X.jobs(spark, d).select(F.lit("job").alias("source"), F.col("job_id").alias("id"),
                                   F.col("settings.name").alias("name"))
    parts = X.table(spark, d, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                                             F.col("p_name").alias("name"))
    cust = X.table(spark, d, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"),
                                                F.col("c_name").alias("name"))
    return jobs.unionByName(parts).unionByName(cust)


@register("job_name_issues", "SELECT source, id, name, CASE WHEN issues IS NOT NULL THEN 'Y' ELSE 'N' END AS job_name_flag, "
          "issues AS job_name_issues FROM (SELECT *, " + O._issues().replace("job_name", "name") + " AS issues FROM ("
          f"SELECT 'job' AS source, job_id AS id, job_name AS name FROM {_JOBS_SQL} "
          "UNION ALL SELECT 'part', p_partkey, p_name FROM part UNION ALL SELECT 'customer', c_custkey, c_name FROM customer))")
def q_job_name_issues(spark: SparkSession, d: str) -> DataFrame:
    n = _names(spark, d)
    return n.select("source", "id", "name", J.job_name_flag("name").alias("job_name_flag"),
                    J.job_name_issues("name").alias("job_name_issues"))


@register("recency_flag", f"SELECT o_orderkey, o_orderdate, CASE WHEN CAST(o_orderdate AS TIMESTAMP) >= "
          f"TIMESTAMP {O.q(X.AS_OF)} - INTERVAL 6 MONTH THEN 'Y' ELSE 'N' END AS ran_last_6_months FROM orders")
def q_recency_flag(spark: SparkSession, d: str) -> DataFrame:
    o = X.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", "o_orderdate",
                    J.recency_flag(F.col("o_orderdate").cast("timestamp"), F.lit(X.AS_OF).cast("timestamp"))
                    .alias("ran_last_6_months"))
