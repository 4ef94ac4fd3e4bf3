"""Failure log over small landed JSON: one run per branch."""
import json
import os

from runlens.operators import failures as FL
from runlens.sources import landed as S

H = 3_600_000
T0 = 1_704_844_800_000  # 2024-01-10T00:00:00Z


def land(path, docs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def run(rid, state="FAILED", start=T0 + H, **kw):
    r = {"run_id": rid, "job_id": 100 + rid, "run_name": f"r{rid}", "run_page_url": f"/r/{rid}",
         "start_time": start, "end_time": start + 5000,
         "state": {"life_cycle_state": "TERMINATED", "result_state": state, "state_message": f"msg {rid}"}}
    r.update(kw)
    return r


def landed_fixture(root):
    runs = [run(1), run(2, attempt_number=2), run(3), run(4), run(5), run(6), run(7),
            run(8, state="SUCCESS"), run(9, start=T0 + 10 * 24 * H), run(10)]
    land(f"{root}/pages/p1.json", [{"runs": runs[:5], "has_more": True, "next_page_token": "a"}])
    land(f"{root}/pages/p2.json", [{"runs": runs[5:], "has_more": False}])
    outs = [
        {"run_id": 1, "http_status": 200, "body": {"error": "", "metadata": {
            "job_name": "", "run_name": "meta run", "start_time": 0,
            "state": {}, "status": {"state": "TERMINATED", "state_message": "Timeout on TABLE",
                                    "termination_details": {"code": "C", "type": "T", "reason": "R"}},
            "task": {"notebook_task": {}}}}},
        {"run_id": 2, "http_status": 400, "response_text": "Run with multiple tasks is not supported"},
        {"run_id": 3, "http_status": 400, "response_text": "Run with multiple tasks is not supported"},
        {"run_id": 4, "http_status": 500, "response_text": "boom"},
        {"run_id": 5, "http_status": 500, "response_text": "boom"},
        {"run_id": 7, "http_status": 400, "response_text": "Run with multiple tasks is not supported"},
        {"run_id": 10, "http_status": 400, "response_text": "Run with multiple tasks is not supported"},
        # task outputs: own id 21, key-only task 'b' of run 2, failing own id 23
        {"run_id": 21, "http_status": 200, "body": {"error": "E21"}},
        {"run_id": 2, "task_key": "b", "http_status": 200, "body": {"error": ""}},
        {"run_id": 23, "http_status": 404, "response_text": "gone"},
    ]
    land(f"{root}/outputs/o.json", outs)
    dets = [
        {"run_id": 2, "http_status": 200, "body": {"job_name": "job two", "original_attempt_run_id": "0", "tasks": [
            {"task_key": "a", "run_id": 21, "sql_task": {}},
            {"task_key": "b"},
            {"task_run_id": 23},
            {},
        ]}},
        {"run_id": 3, "http_status": 404, "response_text": "no run"},
        {"run_id": 4, "http_status": 200, "body": {"job_name": "four", "task": {"dbt_task": {}}}},
        {"run_id": 10, "http_status": 200, "body": {"tasks": []}},
    ]
    land(f"{root}/details/d.json", dets)


def test_branches(spark, scratch):
    landed_fixture(scratch)
    runs = S.read_run_pages(spark, f"{scratch}/pages")
    outs = S.read_run_outputs(spark, f"{scratch}/outputs")
    dets = S.read_run_details(spark, f"{scratch}/details")
    rows = FL.failure_rows(runs, outs, dets, window=(T0, T0 + 24 * H)).collect()
    by = {}
    for r in rows:
        by.setdefault((r.run_id, r.row_kind), []).append(r)
    kinds = sorted({k for k in by})
    assert kinds == [(1, "single"), (2, "multi_summary"), (2, "multi_task"), (3, "fallback"), (4, "generic"),
                     (5, "generic"), (6, "generic"), (7, "fallback"), (10, "multi_summary")]
    single = by[(1, "single")][0]
    assert single.job_name == "meta run" and single.run_name == "meta run"
    assert single.life_cycle_state == "TERMINATED" and single.state_message == "Timeout on TABLE"
    assert (single.termination_code, single.error_category, single.error_provider) == ("C", "TIMEOUT", "UNITY_CATALOG")
    assert single.task_type == "notebook_task" and single.job_start_datetime_iso.startswith("2024-01-10T01:00:00")
    multi = by[(2, "multi_summary")][0]
    assert multi.output_error == ("a: E21; b: no error field; 23: get-output error: runs/get-output failed for "
                                  "run_id=23: HTTP 404 - gone; unknown_task: no error field")
    assert multi.job_name == "job two" and multi.is_retry and multi.attempt_number == 2
    assert multi.original_attempt_run_id == 0
    children = by[(2, "multi_task")]
    assert sorted((c.child_task_key or "", c.child_task_run_id or 0) for c in children) == \
        [("", 0), ("", 23), ("a", 21), ("b", 0)]
    assert {c.task_type for c in children if c.child_task_key == "a"} == {"sql_task"}
    fb = by[(3, "fallback")][0]
    assert fb.output_error == "get-output multi-task fallback failed: runs/get failed for run_id=3: HTTP 404 - no run"
    assert fb.job_name == "r3" and fb.task_type is None
    g4 = by[(4, "generic")][0]
    assert (g4.job_name, g4.task_type) == ("four", "dbt_task")
    assert g4.output_error == "get-output error: runs/get-output failed for run_id=4: HTTP 500 - boom"
    assert by[(6, "generic")][0].output_error == "get-output error: no output landed"
    assert by[(7, "fallback")][0].output_error.endswith("no details landed")
    assert by[(10, "multi_summary")][0].output_error.startswith("runs/get-output failed for run_id=10")


def test_window_edge_and_log_schema(spark, scratch):
    landed_fixture(scratch)
    runs = S.read_run_pages(spark, f"{scratch}/pages")
    outs = S.read_run_outputs(spark, f"{scratch}/outputs")
    dets = S.read_run_details(spark, f"{scratch}/details")
    log = FL.failure_log(runs, outs, dets, ingest_iso="2024-02-01T00:00:00+00:00", window=(T0, T0 + H))
    assert log.count() == 0  # starts at T0 + H are outside [T0, T0 + H)
    log = FL.failure_log(runs, outs, dets, ingest_iso="x", window=(T0 + H, T0 + H + 1))
    assert len(log.columns) == 25 and log.columns[-1] == "row_added_at"
    assert dict(log.dtypes)["is_retry"] == "boolean" and dict(log.dtypes)["child_task_run_id"] == "bigint"
    import pytest
    with pytest.raises(ValueError):
        FL.runs_in_window(runs, 10, 5)


def test_dedup_and_new_only(spark, scratch):
    landed_fixture(scratch)
    runs = S.read_run_pages(spark, f"{scratch}/pages")
    outs = S.read_run_outputs(spark, f"{scratch}/outputs")
    dets = S.read_run_details(spark, f"{scratch}/details")
    a = FL.failure_log(runs, outs, dets, ingest_iso="2024-02-01T00:00:00+00:00")
    b = FL.failure_log(runs, outs, dets, ingest_iso="2024-02-02T00:00:00+00:00")
    assert FL.new_only(b, a, FL.event_key(b)).count() == 0
    d = FL.dedup_latest(a.unionByName(b), FL.event_key(a))
    assert {r.row_added_at for r in d.collect()} == {"2024-02-02T00:00:00+00:00"}


def test_relanded_run_counts_once(spark, scratch):
    landed_fixture(scratch)
    # the same failed run landed again in a later page, with a later end time
    land(f"{scratch}/pages/p3.json", [{"runs": [run(4, end_time=T0 + H + 9000)], "has_more": False}])
    runs = S.read_run_pages(spark, f"{scratch}/pages")
    outs = S.read_run_outputs(spark, f"{scratch}/outputs")
    dets = S.read_run_details(spark, f"{scratch}/details")
    rows = [r for r in FL.failure_rows(runs, outs, dets).collect() if r.run_id == 4]
    assert len(rows) == 1 and rows[0].duration_ms == 9000


def test_landed_parquet_prunes_dates(spark, scratch):
    landed_fixture(scratch)
    S.land_run_pages(spark, f"{scratch}/pages", f"{scratch}/runs_parquet")
    landed = S.read_landed_runs(spark, f"{scratch}/runs_parquet")
    outs = S.read_run_outputs(spark, f"{scratch}/outputs")
    dets = S.read_run_details(spark, f"{scratch}/details")
    window = (T0, T0 + 24 * H)
    from_json = FL.failure_rows(S.read_run_pages(spark, f"{scratch}/pages"), outs, dets, window=window)
    from_parquet = FL.failure_rows(landed, outs, dets, window=window)
    assert sorted(map(repr, from_json.collect())) == sorted(map(repr, from_parquet.collect()))
    plan = FL.runs_in_window(landed, *window)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_date" in plan and ">= 2024-01-10" in plan and "<= 2024-01-11" in plan


def read(spark, scratch):
    return (S.read_run_pages(spark, f"{scratch}/pages"), S.read_run_outputs(spark, f"{scratch}/outputs"),
            S.read_run_details(spark, f"{scratch}/details"))


def test_relanded_answers_do_not_multiply_rows(spark, scratch):
    landed_fixture(scratch)
    once = sorted(map(repr, FL.failure_rows(*read(spark, scratch)).collect()))
    for name in ("outputs/o", "details/d"):
        again = [json.loads(line) for line in open(f"{scratch}/{name}.json")]
        land(f"{scratch}/{name}2.json", [{"run_id": a["run_id"], "task_key": a.get("task_key"), "http_status": 503, "landed_at": 1}
                                         for a in again])
        land(f"{scratch}/{name}3.json", [{**a, "landed_at": 2} for a in again])
    assert sorted(map(repr, FL.failure_rows(*read(spark, scratch)).collect())) == once


def test_kinds_with_null_values_and_whole_state(spark, scratch):
    state = {"result_state": "FAILED", "life_cycle_state": "TERMINATED", "queue_reason": "q" * 5000}
    land(f"{scratch}/pages/p.json", [{"runs": [run(1, state=state) | {"state": state}, run(2)]}])
    land(f"{scratch}/outputs/o.json", [
        {"run_id": 1, "http_status": 200, "body": {"metadata": {"notebook_task": None, "sql_task": {}}}},
        {"run_id": 2, "http_status": 400, "response_text": "Run with multiple tasks is not supported"}])
    land(f"{scratch}/details/d.json", [{"run_id": 2, "http_status": 200, "body": {
        "tasks": [{"task_key": "a", "pipeline_task": None, "dbt_task": {}}, {"task_key": "b", "task": {"sql_task": None}}]}}])
    runs, outputs, details = read(spark, scratch)
    kinds = {(r.run_id, r.child_task_key): r.task_type for r in FL.failure_rows(runs, outputs, details).collect()}
    assert kinds == {(1, None): "notebook_task", (2, None): "multi_task_run", (2, "a"): "pipeline_task", (2, "b"): "sql_task"}
    whole = {r.run_id: r.state_json for r in FL.debug_rows(runs, host=None, ingest_iso="x", max_chars=None).collect()}
    assert json.loads(whole[1]) == state
    assert len(FL.debug_rows(runs, host=None, ingest_iso="x").where("run_id = 1").first().state_json) == 4000


def test_dedup_keeps_every_row_of_a_run(spark, scratch):
    landed_fixture(scratch)
    logs = [FL.failure_log(*read(spark, scratch), ingest_iso=f"2024-02-0{i}T00:00:00+00:00") for i in (1, 2)]
    both = logs[0].where("run_id <> 5").unionByName(logs[1].where("run_id <> 4"))
    kept = FL.dedup_runs(both).collect()
    assert len(kept) == logs[0].count()  # run 2 has task rows without an id and without a key
    assert {r.row_added_at[9] for r in kept if r.run_id == 4} == {"1"} and {r.row_added_at[9] for r in kept if r.run_id != 4} == {"2"}
