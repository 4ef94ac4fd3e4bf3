"""Sinks in a temporary warehouse, watermark, and the streaming ingest."""
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from runlens.operators import failures as FL
from runlens.operators.masking import masked_view
from runlens.schemas import FAILURE_LOG_FIELDS
from runlens.sinks import tables as K
from runlens.sources import landed as S
from runlens.streaming import ingest as I
from runlens.streaming import watermark as W
from test_pipeline import T0, H, landed_fixture, land, run


def test_create_evolve_append(spark):
    spark.sql("DROP TABLE IF EXISTS t_log")
    K.ensure_table(spark, "t_log", [("a", "bigint"), ("b", "string")])
    added = K.ensure_table(spark, "t_log", [("a", "bigint"), ("b", "string"), ("c", "boolean")])
    assert added == ["c"]
    K.append_by_name(spark.createDataFrame([("x", 1)], "b string, a bigint"), "t_log")
    r = spark.table("t_log").first()
    assert (r.a, r.b, r.c) == (1, "x", None)


def test_replace_and_metadata(spark):
    spark.sql("DROP TABLE IF EXISTS t_inv")
    K.replace_table(spark.createDataFrame([(1, "a")], "id bigint, old string"), "t_inv")
    K.replace_table(spark.createDataFrame([(2,)], "id bigint"), "t_inv")
    assert spark.table("t_inv").columns == ["id", "old"]
    K.comment_table(spark, "t_inv", "it's a table")
    K.set_table_tags(spark, "t_inv", {"team": "ops"})
    K.comment_columns(spark, "t_inv", {"id": "job id"})
    K.tag_columns(spark, "t_inv", {"id": {"pii": "no"}})
    props = {r.key: r.value for r in K.table_properties(spark, "t_inv").collect()}
    assert props["team"] == "ops" and props["column.id.tag.pii"] == "no"
    K.overwrite_table(spark.createDataFrame([(3,)], "other bigint"), "t_inv")
    assert spark.table("t_inv").columns == ["other"]


def test_masks(spark):
    df = spark.createDataFrame([("Ab1", "u", "m")], "n string, url string, msg string")
    r = masked_view(df, {"n": "mask", "url": "hash", "msg": "null"}).first()
    assert r.n == "Xxn" and len(r.url) == 64 and r.msg is None


def test_watermark(spark):
    spark.sql("DROP TABLE IF EXISTS t_state")
    assert W.read_watermark(spark, "t_state", None) is None
    W.write_watermark(spark, "t_state", "2024-01-10T00:00:00Z", "now")
    W.write_watermark(spark, "t_state", "2024-01-11T00:00:00+00:00", "now")
    W.write_watermark(spark, "t_state", "2024-01-20T00:00:00Z", "now", state_id="other")
    assert W.read_watermark(spark, "t_state", None) == T0 + 24 * H
    assert W.read_watermark(spark, "t_state", None, state_id="other") == T0 + 240 * H
    w = W.resolve_window(spark, end="2024-01-12T00:00:00Z", state_table="t_state", lookback=timedelta(0))
    assert (w.start_ms, w.end_ms) == (T0 + 24 * H, T0 + 48 * H)
    w = W.resolve_window(spark, end="2024-01-12T00:00:00Z", state_table="t_state")
    assert w.start_ms == T0 + 24 * H - 48 * H  # two days of lookback
    w = W.resolve_window(spark, start="2024-01-11", end="2024-01-12", state_table="t_state")
    assert w.start_ms == T0 + 24 * H  # an explicit start stays
    W.write_watermark(spark, "t_state", "2024-01-05T00:00:00Z", "now2")  # the row written last, not the latest time
    assert W.read_watermark(spark, "t_state", None) == T0 - 120 * H
    df = spark.createDataFrame([("2024-01-10T00:00:00Z",), ("2024-01-10T00:30:00+01:00",)], "t string")
    assert W.watermark_of(df, "t").first().watermark_ms == T0  # instant order, not text order


def test_batch_ingest_twice_adds_nothing(spark, scratch):
    landed_fixture(scratch)
    for t in ("t_fail", "t_fail_state"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    runs = S.read_run_pages(spark, f"{scratch}/pages")
    outs = S.read_run_outputs(spark, f"{scratch}/outputs")
    dets = S.read_run_details(spark, f"{scratch}/details")
    now = datetime(2024, 1, 12, tzinfo=timezone.utc)
    I.ingest_batch(spark, runs, outs, dets, log_table="t_fail", state_table="t_fail_state",
                   start="2024-01-10", end="2024-01-11", now=now)
    n1 = spark.table("t_fail").count()
    I.ingest_batch(spark, runs, outs, dets, log_table="t_fail", state_table="t_fail_state",
                   start="2024-01-10", end="2024-01-11", now=now)
    spark.catalog.refreshTable("t_fail")
    assert n1 > 0 and spark.table("t_fail").count() == n1
    assert [f for f, _ in FAILURE_LOG_FIELDS] + [I.RUN_DATE] == spark.table("t_fail").columns
    # rows of a run are replaced together, those of other runs and dates stay
    land(f"{scratch}/outputs/late.json", [{"run_id": 6, "http_status": 200, "landed_at": 5, "body": {"error": "late answer"}}])
    I.ingest_batch(spark, S.read_run_pages(spark, f"{scratch}/pages"), S.read_run_outputs(spark, f"{scratch}/outputs"), dets,
                   log_table="t_fail", state_table="t_fail_state", end="2024-01-12", now=now)
    after = spark.table("t_fail").collect()
    assert len(after) == n1 and [r.output_error for r in after if r.run_id == 6] == ["late answer"]
    plan = spark.table("t_fail").where("run_date = date'2024-01-10'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_stream_equals_batch(spark, scratch):
    landed_fixture(scratch)
    spark.sql("DROP TABLE IF EXISTS t_stream")
    outs = lambda s: S.read_run_outputs(s, f"{scratch}/outputs")
    dets = lambda s: S.read_run_details(s, f"{scratch}/details")
    stamp = lambda: "2024-02-01T00:00:00+00:00"
    ck = os.path.join(scratch, "ck")
    src = os.path.join(scratch, "stream_pages")
    os.makedirs(src)
    os.link(f"{scratch}/pages/p1.json", f"{src}/p1.json")
    q = I.start_failure_stream(spark, src, outs, dets, "t_stream", checkpoint=ck, ingest_iso=stamp)
    q.awaitTermination()
    os.link(f"{scratch}/pages/p2.json", f"{src}/p2.json")
    q = I.start_failure_stream(spark, src, outs, dets, "t_stream", checkpoint=ck, ingest_iso=stamp)
    q.awaitTermination()
    q = I.start_failure_stream(spark, src, outs, dets, "t_stream", checkpoint=ck, ingest_iso=stamp,
                               max_files_per_trigger=1)
    q.awaitTermination()
    spark.catalog.refreshTable("t_stream")
    got = sorted(tuple(map(repr, r)) for r in spark.table("t_stream").drop(I.RUN_DATE).collect())
    batch = FL.failure_log(S.read_run_pages(spark, f"{scratch}/pages"), outs(spark), dets(spark),
                           ingest_iso=stamp())
    assert got == sorted(tuple(map(repr, r)) for r in batch.collect())


def test_stream_corrects_runs_whose_output_lands_later(spark, scratch):
    spark.sql("DROP TABLE IF EXISTS t_late")
    land(f"{scratch}/outputs/o0.json", [])
    land(f"{scratch}/details/d0.json", [])
    outs = lambda s: S.read_run_outputs(s, f"{scratch}/outputs")
    dets = lambda s: S.read_run_details(s, f"{scratch}/details")

    def trigger():
        I.start_failure_stream(spark, f"{scratch}/pages", outs, dets, "t_late", checkpoint=f"{scratch}/ck").awaitTermination()
        spark.catalog.refreshTable("t_late")
        return {(r.run_id, r.child_task_key): r.output_error for r in spark.table("t_late").collect()}

    refused = {"http_status": 400, "response_text": "Run with multiple tasks is not supported"}
    land(f"{scratch}/pages/p1.json", [{"runs": [run(1), run(2), run(4), run(5)]}])
    land(f"{scratch}/outputs/o4.json", [{"run_id": 4, **refused}, {"run_id": 5, **refused}])
    land(f"{scratch}/details/d5.json", [{"run_id": 5, "http_status": 200, "body": {"tasks": [
        {"task_key": "a", "run_id": 51}, {"task_key": "b", "run_id": 52}]}}])
    land(f"{scratch}/outputs/o52.json", [{"run_id": 52, "http_status": 200, "body": {"error": "E52"}}])
    first = trigger()
    assert first[1, None] == first[2, None] == "get-output error: no output landed"
    assert first[4, None].endswith("no details landed") and first[5, None] == "a: get-output error: no output landed; b: E52"
    land(f"{scratch}/details/d4.json", [{"run_id": 4, "http_status": 200, "body": {"tasks": []}}])  # a fallback's details
    land(f"{scratch}/outputs/o51.json", [{"run_id": 51, "http_status": 200, "body": {"error": "E51"}}])  # not the last task's
    land(f"{scratch}/outputs/o1.json", [{"run_id": 1, "http_status": 400, "response_text": "Run with multiple tasks is not supported"},
                                        {"run_id": 11, "http_status": 200, "body": {"error": "E"}}])
    land(f"{scratch}/details/d1.json", [{"run_id": 1, "http_status": 200, "body": {"tasks": [{"task_key": "a", "run_id": 11}, {}]}}])
    land(f"{scratch}/pages/p2.json", [{"runs": [run(3)]}])
    after = trigger()
    assert after[1, None] in ("a: E; unknown_task: no error field", None) and (1, "a") in after
    assert after[4, None] != first[4, None] and after[5, None] == "a: E51; b: E52"
    assert spark.table("t_late").where("run_id = 1").count() == 3 and len({k[0] for k in after}) == 5


def test_view_and_layout(spark, scratch):
    from runlens.operators import ownership as OWN
    from runlens.plans import registry as RG
    from runlens.sources import fixtures as X
    d = "/root/testdata/sf0.001"
    for t in ("t_summary", "t_crosswalk", "t_cost"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    summary = RG.summary(spark, d)
    summary.write.saveAsTable("t_summary")
    X.crosswalk(spark, d).write.saveAsTable("t_crosswalk")
    X.job_cost(spark, d).write.saveAsTable("t_cost")
    OWN.create_view(spark, "v_migration", "t_summary", "t_crosswalk", "t_cost")
    by_sql = sorted(map(repr, spark.table("v_migration").collect()))
    by_df = sorted(map(repr, OWN.migration_list(spark.table("t_summary"), OWN.project_tracker(X.crosswalk(spark, d)),
                                                  X.job_cost(spark, d)).collect()))
    assert by_sql == by_df and len(by_sql) > 0
    log = RG.QUERIES["failure_log"](spark, d)
    spark.sql("DROP TABLE IF EXISTS t_laid_out")
    K.write_laid_out(log, "t_laid_out", partitions=4)
    spark.catalog.refreshTable("t_laid_out")
    assert spark.table("t_laid_out").count() == log.count()
    assert "end_date" in spark.table("t_laid_out").columns


def test_lookup_readers(spark, scratch):
    land(f"{scratch}/clusters/c.json", [{"cluster_id": "c1", "spark_version": "14.3.x"}])
    land(f"{scratch}/objects/o.json", [{"path": "/a/b", "language": "PYTHON"}])
    land(f"{scratch}/jobs/j.json", [{"job_id": 1, "settings": {"name": "n", "tags": {"team": "a"}, "tasks": [
        {"task_key": "t", "existing_cluster_id": "c1", "notebook_task": {"notebook_path": "/a/b"}}]}},
        {"job_id": 2, "settings": {"name": "empty"}}])
    land(f"{scratch}/runs/r.json", [{"job_id": 1, "run_id": 5, "start_time": 1000, "end_time": 1150,
                                      "state": {"result_state": "FAILED"}}])
    from runlens.operators import inventory as INV
    inv = INV.job_inventory(S.read_jobs(spark, f"{scratch}/jobs"), S.read_clusters(spark, f"{scratch}/clusters"),
                            S.read_workspace_objects(spark, f"{scratch}/objects"),
                            S.read_job_runs(spark, f"{scratch}/runs"))
    rows = {r.job_id: r for r in INV.as_table(inv).collect()}
    r = rows[1]
    assert (r.task_type, r.cluster_type, r.dbr_version, r.notebook_name, r.notebook_language) == \
        ("notebook", "interactive", "14.3.x", "b", "PYTHON")
    assert (r.last_run_status, r.last_run_duration_seconds, r.job_tags) == ("FAILED", 0.2, '{"team":"a"}')
    assert rows[2].task_key is None and rows[2].task_type is None and rows[2].job_tags is None
