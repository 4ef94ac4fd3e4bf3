"""Landed-record fixtures projected from the driver tables.

The test tables hold no job runs or job definitions, so these functions shape
them into the payloads the pipelines read (schemas in ``runlens.schemas``).
Every projection is a plain DataFrame plan over the parquet scans: it grows
with the tables, is pruned to the columns it needs, and is re-derived on
every call. The same projections are restated in DuckDB SQL in
``runlens.plans.oracle``; FIXTURES.md §3 documents them.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.jobs import JOB_TASK_KINDS
from ..functions.runs import RUN_TASK_KINDS
from ..session import stored

# Fixed window, as-of time and ingest stamps used by the registered queries.
WINDOW = ("2024-01-10T00:00:00Z", "2024-01-20T00:00:00Z")
AS_OF = "1998-02-01 00:00:00"
INGEST_ISO = "2024-02-01T00:00:00+00:00"
REINGEST_ISO = "2024-02-02T00:00:00+00:00"
TASK_ID_BASE = 10_000_000
MISSING_ID_SHIFT = 100_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LANDED_CONF = "runlens.landed.dir"


def landed(fn):
    """Read a projection from the folder that ``runlens.landed.dir`` names, where
    :func:`land_fixtures` has written it; else derive it from the driver tables."""
    @functools.wraps(fn)
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = spark.conf.get(LANDED_CONF, None)
        return spark.read.parquet(f"{folder}/{fn.__name__}") if folder else fn(spark, sf_dir)
    return wrapped


def land_fixtures(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write every landed shape of the driver tables once as parquet."""
    for name in sorted(LANDED):
        globals()[name](spark, sf_dir).write.parquet(f"{folder}/{name}")


# The projections that play landed tables (the others are intermediate).
LANDED = {"run_records", "run_outputs", "run_details", "jobs", "clusters", "workspace_objects",
          "job_runs", "crosswalk", "job_cost"}


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _s(c: Column | int | str) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


def _kind_of(ix: Column, kinds: list[str]) -> Column:
    out = F.lit(None).cast("string")
    for i, k in reversed(list(enumerate(kinds))):
        out = F.when(ix == i, F.lit(k)).otherwise(out)
    return out


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per event (all event types; FAILED for 'error')."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("bigint")
    start = _ms(F.col("ts"))
    run_id = F.col("event_id") + 1
    job_id = F.col("user_id") + 1
    result_state = (
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type").isin("signup", "purchase"), "SUCCESS")
        .when(F.col("event_type") == "view", "CANCELED")
    )
    error_text = (
        F.when(k % 7 == 0, "Run with multiple tasks is not supported")
        .when(k % 7 == 1, "PERMISSION_DENIED: no access to table")
        .when(k % 7 == 2, "Timeout while cloning GitHub repo")
        .when(k % 7 == 3, "INTERNAL_ERROR in pipeline update, NOT_FOUND")
        .when(k % 7 == 4, "")
        .when(k % 7 == 5, F.lit(None))
        .otherwise("plain failure")
    )
    state = F.struct(
        F.lit("TERMINATED").alias("life_cycle_state"),
        result_state.alias("result_state"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("Run ended: code "), _s(k))).alias("state_message"),
    )
    return ev.select(
        run_id.alias("run_id"),
        job_id.alias("job_id"),
        F.when(k % 6 == 5, F.lit(None)).otherwise(F.concat(F.lit("run "), _s(job_id))).alias("run_name"),
        F.concat(F.lit("/jobs/"), _s(job_id), F.lit("/runs/"), _s(run_id)).alias("run_page_url"),
        start.alias("start_time"),
        F.when(k % 13 == 0, F.lit(0).cast("bigint"))
        .otherwise(start + F.floor(F.col("value") * 1000).cast("bigint")).alias("end_time"),
        state.alias("state"),
        # the object as landed has a field that the typed columns lack
        F.to_json(state.withField("user_cancelled_or_timedout", F.lit(False))).alias("state_raw"),
        _s(F.when(k % 5 != 4, k % 5)).alias("attempt_number"),
        F.lit(None).cast("string").alias("run_attempt"),
        _s(F.when(k % 4 == 1, run_id).when(k % 4 != 0, run_id - k)).alias("original_attempt_run_id"),
        error_text.alias("_error_text"),
        k.alias("_k"),
    )


@landed
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in the landed page-entry shape (helper columns dropped)."""
    return runs(spark, sf_dir).drop("_error_text", "_k")


PAGE_RUNS = 26  # runs of a listing's page


def run_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of the listings of every day, in the shape of RUN_PAGE (the runs with their ids alone).

    By day of month modulo 8: 1 the second page is lost, 2 the last page goes back to the second, 3 the second is
    landed twice, 4 the first is landed again as if it were the last, 5 the first is lost, 6 the same as in 4 but
    earlier, 7 the last page has more but no token.
    """
    ev = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    place = F.row_number().over(Window.partitionBy("day").orderBy("event_id")) - 1
    pages = ev.withColumn("p", F.floor(place / PAGE_RUNS).cast("int")).groupBy("day", "p").agg(
        F.array_sort(F.collect_list(F.struct((F.col("event_id") + 1).alias("run_id")))).alias("runs"))
    lasts = pages.groupBy("day").agg(F.max("p").alias("last"))
    p, last, fault = F.col("p"), F.col("last"), F.dayofmonth("day") % 8
    start = _ms(F.col("day"))
    back = (fault == 2) & (p == last) & (last >= 1)
    more = back | (p < last) | ((fault == 7) & (p == last))
    base = pages.join(lasts, "day").select(
        "runs", more.alias("has_more"),
        F.when(back, "t1").when(p < last, F.concat(F.lit("t"), _s(p + 1))).alias("next_page_token"),
        start.alias("start_time_from"), (start + 86_400_000).alias("start_time_to"),
        F.when(p > 0, F.concat(F.lit("t"), _s(p))).alias("page_token"),
        F.when(fault == 6, 2).cast("long").alias("landed_at"), p.alias("p"), fault.alias("fault"))
    fault = F.col("fault")
    again = base.where(((fault == 3) & (p == 1)) | (fault.isin(4, 6) & (p == 0))).withColumns({
        "has_more": F.col("has_more") & (fault == 3),
        "next_page_token": F.when(fault == 3, F.col("next_page_token")),
        "landed_at": F.when(fault == 6, 1).cast("long")})
    lost = ((fault == 1) & (p == 1)) | ((fault == 5) & (p == 0))
    return base.where(~lost).unionByName(again).drop("p", "fault")


def run_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of a run: one per (order, line number) of lineitem."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    g = li.groupBy((F.col("l_orderkey") + 1).alias("run_id"), F.col("l_linenumber").alias("pos")).agg(
        F.min("l_partkey").alias("p")
    )
    p, pos, rid = F.col("p"), F.col("pos"), F.col("run_id")
    return g.select(
        rid, pos, p,
        F.when(p % 6 != 0, F.concat(F.lit("t"), _s(pos))).alias("task_key"),
        F.when(p % 5 != 0, F.lit(TASK_ID_BASE) + rid * 10 + pos).alias("task_run_id"),
        F.when(p % 4 == 1, 404).otherwise(200).alias("http_status"),
        F.when(p % 3 != 0, F.concat(F.lit("E"), _s(p))).alias("task_error"),
    )


def _metadata(k: Column, r: Column) -> Column:
    kinds = {kk: F.lit(None).cast("string") for kk in RUN_TASK_KINDS}
    kinds["sql_task"] = F.when(k % 10 == 1, F.lit("{}"))
    task_raw = (
        F.when(k % 10 == 0, F.lit(None))
        .when(k % 10 == 1, F.lit("{}"))
        .otherwise(F.concat(F.lit('{"'), _kind_of(k % 9, RUN_TASK_KINDS), F.lit('":{}}')))
    )
    state = F.struct(
        F.lit("TERMINATED").alias("life_cycle_state"),
        F.lit(None).cast("string").alias("state"),
        F.lit("FAILED").alias("result_state"),
        r.getField("state").getField("state_message").alias("state_message"),
        F.struct(F.lit("RUN_EXECUTION_ERROR").alias("code"), F.lit("CLIENT_ERROR").alias("type"),
                 F.lit(None).cast("string").alias("reason")).alias("termination_details"),
    )
    status = F.struct(
        F.lit(None).cast("string").alias("life_cycle_state"),
        F.lit("TERMINATED").alias("state"),
        F.lit(None).cast("string").alias("result_state"),
        F.lit("Cluster terminated").alias("state_message"),
        F.struct(F.lit("DRIVER_ERROR").alias("code"), F.lit("CLOUD_FAILURE").alias("type"),
                 F.lit("spot instance lost").alias("reason")).alias("termination_details"),
    )
    job_id = r.getField("job_id")
    return F.struct(
        F.when(k % 10 != 3, job_id).alias("job_id"),
        F.when(k % 3 == 1, F.lit(None)).when(k % 3 == 2, F.lit(""))
        .otherwise(F.concat(F.lit("job-"), _s(job_id))).alias("job_name"),
        F.lit(None).cast("string").alias("run_name"),
        F.lit(None).cast("string").alias("run_page_url"),
        r.getField("start_time").alias("start_time"),
        r.getField("end_time").alias("end_time"),
        F.when(k % 4 == 3, F.lit("2")).alias("attempt_number"),
        task_raw.alias("task"),
        F.when(k % 2 == 0, state).alias("state"),
        F.when(k % 2 == 1, status).alias("status"),
        *[kinds[kk].alias(kk) for kk in RUN_TASK_KINDS],
    )


@landed
def run_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed get-output answers: one per run, plus one per addressable task."""
    return _outputs_of(runs(spark, sf_dir), run_tasks(spark, sf_dir))


def _outputs_of(r: DataFrame, t: DataFrame) -> DataFrame:
    k = F.col("_k")
    status = F.when(k % 7 == 0, 400).when(k % 11 == 1, 500).otherwise(200)
    run_level = r.select(
        "run_id",
        F.lit(None).cast("string").alias("task_key"),
        status.alias("http_status"),
        F.when(status >= 400, F.coalesce(F.col("_error_text"), F.lit(""))).alias("response_text"),
        F.when(status < 400, F.struct(
            F.col("_error_text").alias("error"),
            _metadata(k, F.struct(*[F.col(c) for c in ("job_id", "start_time", "end_time", "state")])).alias("metadata"),
        )).alias("body"),
    )
    by_id = F.col("task_run_id").isNotNull()
    task_level = t.where(by_id | F.col("task_key").isNotNull()).select(
        F.when(by_id, F.col("task_run_id")).otherwise(F.col("run_id")).alias("run_id"),
        F.when(by_id, F.lit(None)).otherwise(F.col("task_key")).cast("string").alias("task_key"),
        F.col("http_status"),
        F.when(F.col("http_status") >= 400, F.lit('{"error_code":"RESOURCE_DOES_NOT_EXIST"}')).alias("response_text"),
        F.when(F.col("http_status") < 400, F.struct(
            F.col("task_error").alias("error"),
            F.lit(None).cast(run_level.schema["body"].dataType["metadata"].dataType).alias("metadata"),
        )).alias("body"),
    )
    return run_level.unionByName(task_level)


@landed
def run_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed runs/get answers: one per run, tasks nested in position order."""
    return _details_of(runs(spark, sf_dir).select("run_id", "job_id", "_k"), run_tasks(spark, sf_dir))


def _details_of(r: DataFrame, t: DataFrame) -> DataFrame:
    tid = F.col("task_run_id")
    elem = F.struct(
        F.col("task_key").alias("task_key"),
        F.when(F.col("pos") % 2 == 0, tid).alias("run_id"),
        F.when(F.col("pos") % 2 == 1, tid).alias("task_run_id"),
        F.lit(None).cast("string").alias("task"),
        *[F.when(F.col("p") % 10 == i, F.lit("{}")).alias(kk) for i, kk in enumerate(RUN_TASK_KINDS)],
        # every seventh payload names its first kind with a null value: present, though its field is null
        F.when(F.col("p") % 7 == 0, F.array(F.lit("task_key"), F.lit(RUN_TASK_KINDS[0]))).alias("payload_keys"),
    )
    nested = t.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("pos", elem.alias("task")))).alias("tasks"))
    tasks = F.col("tasks.task")
    k = F.col("_k")
    status = F.when(k % 5 == 1, 404).otherwise(200)
    job_id = F.col("job_id")
    body = F.struct(
        job_id.alias("job_id"),
        F.when(k % 9 != 0, F.concat(F.lit("job-"), _s(job_id))).alias("job_name"),
        F.when(k % 8 == 0, F.lit("3")).alias("attempt_number"),
        F.when(k % 8 == 1, F.lit("0")).alias("original_attempt_run_id"),
        F.when(k % 2 == 0, F.concat(F.lit('{"'), _kind_of((k + 4) % 9, RUN_TASK_KINDS), F.lit('":{}}'))).alias("task"),
        *[F.lit(None).cast("string").alias(kk) for kk in RUN_TASK_KINDS],
        tasks.alias("tasks"),
    )
    return r.join(nested, "run_id", "left").select(
        "run_id",
        status.alias("http_status"),
        F.when(status >= 400, F.concat(F.lit("RESOURCE_DOES_NOT_EXIST: Run "), _s(F.col("run_id")),
                                       F.lit(" does not exist"))).alias("response_text"),
        F.when(status < 400, body).alias("body"),
    )


def landed_once(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs, outputs and details for a query that reads them many times. Where they are not landed already, the tasks
    and the details are written once as Parquet: deriving them takes three shuffles, which every read would repeat."""
    if spark.conf.get(LANDED_CONF, None):
        return run_records(spark, sf_dir), run_outputs(spark, sf_dir), run_details(spark, sf_dir)
    r, t = runs(spark, sf_dir), stored(run_tasks(spark, sf_dir), "tasks")
    # tasks are shuffled before they are nested, which makes them more than twice as large
    details = _details_of(r.select("run_id", "job_id", "_k"), t.repartition("run_id"))
    return run_records(spark, sf_dir), _outputs_of(r, t), stored(details, "details")


# ---------------------------------------------------------------- job side

def _job_name(okey: Column) -> Column:
    names = {0: None, 1: "nightly-dev-load", 2: "etl PROD orders", 3: "my_report tmp",
             4: "Copy of ledger (2)", 5: "New Job 12", 6: "stg qa testing", 7: "",
             8: "null", 9: "demo_v3", 10: "my_dev_job"}
    out = F.concat(F.lit("orders "), F.col("o_orderpriority"))
    for i, n in reversed(list(names.items())):
        out = F.when(okey % 12 == i, F.lit(n).cast("string")).otherwise(out)
    return out


# Tag payloads (compact JSON) per order key % 6; 0 has no tags, 5 an empty map.
TAG_TEXTS = [
    None,
    '{"application":"billing"}',
    '{"Cost-Center":"cc7","team":"alpha"}',
    '{"supporting team":"","team":"beta","Domain":"sales"}',
    '{"Team":"x","team":"y"}',
    "{}",
]


def _tags(okey: Column) -> Column:
    txt = F.lit(None).cast("string")
    for i, t in reversed(list(enumerate(TAG_TEXTS))):
        txt = F.when(okey % 6 == i, F.lit(t).cast("string")).otherwise(txt)
    return F.from_json(txt, "map<string,string>")


def _version(major: Column, minor: Column) -> Column:
    return F.concat(_s(F.lit(9) + major), F.lit("."), _s(minor), F.lit(".x-scala2.12"))


def job_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task definitions from lineitem rows (job = order)."""
    # dealt by job as they are: made tasks before, they would be several times as large
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + 1).alias("job_id"), "l_partkey", "l_suppkey", "l_linenumber").repartition("job_id")
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    type_ix, compute_ix = p % 14, s % 7
    kind_fields = {
        f"{k}_task": F.when(type_ix == i, F.lit("{}"))
        for i, k in enumerate(JOB_TASK_KINDS) if k != "notebook"
    }
    cluster_id = F.concat(F.lit("cl-"), _s(s + F.when(p % 10 == 0, MISSING_ID_SHIFT).otherwise(0)))
    nb_path = F.concat(F.lit("/Workspace/p"), _s(p % 50), F.lit("/nb_"),
                       _s(p + F.when(s % 9 == 0, MISSING_ID_SHIFT).otherwise(0)))
    task = F.struct(
        F.concat(F.lit("t"), _s(F.col("l_linenumber"))).alias("task_key"),
        F.when(compute_ix == 0, F.when(p % 3 == 0, F.lit("jc-missing"))
               .otherwise(F.concat(F.lit("jc-"), _s(p % 7)))).alias("job_cluster_key"),
        F.when((compute_ix == 1) | ((compute_ix == 0) & (s % 2 == 0)), cluster_id).alias("existing_cluster_id"),
        F.when(compute_ix == 3, F.lit("default")).alias("environment_key"),
        F.when(compute_ix == 2, F.struct(
            F.when(p % 5 == 0, F.lit("custom:x")).otherwise(_version(p % 7, s % 4)).alias("spark_version")
        )).alias("new_cluster"),
        F.when(type_ix == 0, F.struct(F.when(p % 11 != 0, nb_path).alias("notebook_path"))).alias("notebook_task"),
        *[c.alias(n) for n, c in kind_fields.items()],
    )
    return li.select("job_id", F.col("l_linenumber").alias("pos"), task.alias("task"))


@landed
def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job definitions: one per order, tasks from its line items (order kept)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    t = job_tasks(spark, sf_dir)
    jc_key = F.col("task").getField("job_cluster_key")
    shared = F.when(jc_key.isNotNull() & (jc_key != "jc-missing"), F.struct(
        jc_key.alias("job_cluster_key"),
        F.struct(_version(F.substring_index(jc_key, "-", -1).try_cast("int"), F.lit(1)).alias("spark_version")).alias("new_cluster"),
    ))
    nested = t.groupBy("job_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "task"))).alias("_tasks"),
        F.sort_array(F.collect_set(shared)).alias("job_clusters"),
    )
    okey = F.col("o_orderkey")
    return o.select((okey + 1).alias("job_id"), _job_name(okey).alias("name"), _tags(okey).alias("tags")).join(
        nested, "job_id", "left"
    ).select(
        "job_id",
        F.struct(
            F.col("name"), F.col("tags"),
            F.col("job_clusters"),
            F.col("_tasks.task").alias("tasks"),
        ).alias("settings"),
    )


@landed
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("cl-"), _s(s)).alias("cluster_id"), _version(s % 7, s % 4).alias("spark_version")
    )


@landed
def workspace_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    lang = F.col("p_size") % 5
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("/Workspace/p"), _s(p % 50), F.lit("/nb_"), _s(p)).alias("path"),
        F.when(lang == 0, "PYTHON").when(lang == 1, "SQL").when(lang == 2, "SCALA").when(lang == 3, "R").alias("language"),
    )


@landed
def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs per job that ran (orders whose key is not a multiple of 9)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    okey = F.col("o_orderkey")
    start = _ms(F.col("o_orderdate"))
    state = F.struct(
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "P", "FAILED").alias("result_state"),
        F.when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("TERMINATED").alias("life_cycle_state"),
    )
    ran = o.where(okey % 9 != 0)
    first = ran.select(
        (okey + 1).alias("job_id"), (okey * 2).alias("run_id"), start.alias("start_time"),
        (start + F.floor(F.col("o_totalprice") * 1000).cast("bigint")).alias("end_time"), state.alias("state"),
    )
    second = ran.select(
        (okey + 1).alias("job_id"), (okey * 2 + 1).alias("run_id"),
        (start - (F.col("o_custkey") % 30) * 86_400_000).alias("start_time"),
        F.when(F.col("o_custkey") % 4 != 0, start - (F.col("o_custkey") % 30) * 86_400_000 + 90_050).alias("end_time"),
        F.struct(F.lit(None).cast("string").alias("result_state"), F.lit("SKIPPED").alias("life_cycle_state")).alias("state"),
    )
    return first.unionByName(second)


@landed
def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    ck, nk = F.col("c_custkey"), F.col("c_nationkey")
    name = (F.when(ck % 6 == 0, "etl PROD orders").when(ck % 6 == 1, "Etl prod orders ")
            .when(ck % 6 == 2, "demo_v3").when(ck % 6 == 3, "null").when(ck % 6 == 4, "unmatched job")
            .otherwise(" NEW JOB 12"))
    return c.select(
        name.alias("job_name"),
        F.when(ck % 4 != 0, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" "))).alias("project_name"),
        F.when(nk % 5 != 0, F.concat(F.lit("tower"), _s(nk % 2), F.when(ck % 3 == 0, " ").otherwise(""))).alias("tower_owner"),
        F.when(nk % 4 == 1, "Untagged").when(nk % 4 >= 2, "mgr").alias("manager"),
        (F.col("c_acctbal") > 2000).alias("is_active"),
    )


@landed
def job_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost rows keyed by job id as text; odd-sized parts are retired ids."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return p.select(
        F.when(F.col("p_size") % 2 == 0, _s(F.col("p_partkey") + 1))
        .otherwise(F.concat(F.lit("retired-"), _s(F.col("p_partkey")))).alias("jobid")
    )


# ---------------------------------------------------------------- ingested intervals

HORIZON = ("1995-06-01", "2001-06-01")


def ingested_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interval of 0 to 89 days for every order, by customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    start = _ms(F.col("o_orderdate"))
    return o.select(_s(F.col("o_custkey")).alias("id"), start.alias("start_ms"),
                    (start + (F.col("o_orderkey") % 90) * 86_400_000).alias("end_ms"))


def ingest_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time that each customer is to be covered for: six years, less some days."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    first, last = (F.unix_millis(F.to_timestamp(F.lit(d))) for d in HORIZON)
    return c.select(_s(F.col("c_custkey")).alias("id"), (first + (F.col("c_custkey") % 10) * 86_400_000).alias("from_ms"),
                    last.alias("to_ms"))
