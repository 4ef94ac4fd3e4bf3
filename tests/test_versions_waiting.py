"""Run versions merged on read, and runs that wait for their parts."""
import itertools
import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from runlens.operators import failures as FL
from runlens.operators.bloom import bloom_filter, looked_up, passes_for, probably_in
from runlens.sinks import versions as V
from runlens.sources import landed as S
from runlens.streaming import waiting as WT
from test_pipeline import T0, H, land, run

DAY = 24 * H
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
MULTI = "Run with multiple tasks is not supported"


def log_rows(spark, rows):
    """(run_id, day, error) rows in the log's columns."""
    df = spark.createDataFrame(rows, "run_id long, run_date string, output_error string")
    return df.withColumn("run_date", F.to_date("run_date")).withColumn("row_added_at", F.lit("x"))


def fresh_table(spark, name):
    for t in (name, f"{name}_compactions"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    return name


def read(spark, table, **dates):
    spark.catalog.refreshTable(table)
    return sorted(((r.run_id, str(r.run_date), r.output_error) for r in V.resolved_log(spark, table, **dates).collect()), key=str)


def parts(spark, table):
    return sorted({r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()})


A, B = "2024-01-01", "2024-01-02"


def test_versions_are_merged_on_read(spark):
    t = fresh_table(spark, "t_versions")
    V.append_version(log_rows(spark, [(1, A, "a"), (1, A, "a2"), (2, A, "b"), (3, B, "c"), (None, None, "n")]), t, 1)
    V.append_version(log_rows(spark, [(1, A, "new")]), t, 2)
    V.append_version(log_rows(spark, [(4, B, "d")]), t, 3, deleted=log_rows(spark, [(3, B, "")]))
    want = [(1, A, "new"), (2, A, "b"), (4, B, "d"), (None, "None", "n")]
    assert read(spark, t) == want
    assert read(spark, t, since=B) == [(4, B, "d")] and read(spark, t, until=A) == want[:2]
    V.append_version(log_rows(spark, [(3, B, "back")]), t, 4)
    V.append_version(log_rows(spark, [(3, B, "back")]), t, 4)  # repeated after a crash
    assert read(spark, t) == sorted([*want, (3, B, "back")], key=str)
    plan = V.resolved_log(spark, t, since=B)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_compaction_takes_busy_dates_and_a_crash_changes_nothing(spark, monkeypatch):
    t = fresh_table(spark, "t_compact")
    for v in range(1, 5):
        V.append_version(log_rows(spark, [(1, A, f"a{v}"), (10 + v, A, "own")]), t, v)
    V.append_version(log_rows(spark, [(2, B, "b")]), t, 5, deleted=log_rows(spark, [(11, A, "")]))
    want = read(spark, t)
    assert (11, A, "own") not in want and (1, A, "a4") in want

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(V, "mark_compacted", crash)
    try:
        V.compact(spark, t, max_versions=3)
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert any(p.endswith("part=c5") for p in parts(spark, t)) and read(spark, t) == want  # written, not marked
    monkeypatch.setattr(V, "_drop_obsolete", crash)
    try:
        V.compact(spark, t, max_versions=3)
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert read(spark, t) == want  # marked, obsolete parts still there
    V.append_version(log_rows(spark, [(1, A, "a6")]), t, 6)
    assert (1, A, "a6") in read(spark, t) and (1, A, "a4") not in read(spark, t)
    assert [str(d) for d in V.compact(spark, t, max_versions=1)] == [A]
    assert read(spark, t) == sorted([r for r in want if r != (1, A, "a4")] + [(1, A, "a6")], key=str)
    assert [p for p in parts(spark, t) if A in p] == [f"run_date={A}/part=c6"]  # only the busy date was written
    assert [p for p in parts(spark, t) if B in p] == [f"run_date={B}/part=v5"]


def deliver(spark, scratch, batches, **options):
    """Feed batches of (kind, record) to ``advance``; returns the state and the log."""
    t = fresh_table(spark, "t_waiting")
    state = WT.State(spark, os.path.join(scratch, "state"))
    for epoch, batch in enumerate(batches):
        lines = [(k, json.dumps(r)) for k, r in batch]
        frame = spark.createDataFrame(lines, "kind string, value string")
        WT.advance(frame, epoch, state=state, log_table=t, now=NOW + timedelta(hours=epoch), **options)
    spark.catalog.refreshTable(t)
    n = len(batches)
    return (V.resolved_log(spark, t), state.read("waiting", n, WT._waiting_schema()), state.read("answers", n, WT.ANSWERS))


def rows_of(log):
    names = [c for c in log.columns if c not in ("row_added_at", "run_date")]
    return sorted(tuple(map(repr, r)) for r in log.select(names).collect())


def whole(spark, scratch, batches):
    """The log that a batch makes of all records together."""
    by = {k: [r for batch in batches for kind, r in batch if kind == k] for k in (WT.PAGE, WT.OUTPUT, WT.DETAILS)}
    for k, records in by.items():
        land(f"{scratch}/all/{k}/r.json", records)
    return FL.failure_log(S.read_run_pages(spark, f"{scratch}/all/page"), S.read_run_outputs(spark, f"{scratch}/all/output"),
                          S.read_run_details(spark, f"{scratch}/all/details"), ingest_iso="x")


def records(rid):
    """The parts of a multi-task run: page, refused output, details, the outputs of a task by id and of one by key."""
    return [
        (WT.PAGE, {"runs": [run(rid), run(rid + 1, state="SUCCESS")]}),
        (WT.OUTPUT, {"run_id": rid, "http_status": 400, "response_text": MULTI}),
        (WT.DETAILS, {"run_id": rid, "http_status": 200, "body": {"job_name": "j", "tasks": [
            {"task_key": "a", "run_id": rid + 50_000_000, "sql_task": {}}, {"task_key": "b"}, {}]}}),
        (WT.OUTPUT, {"run_id": rid + 50_000_000, "http_status": 200, "body": {"error": f"E{rid}"}}),
        (WT.OUTPUT, {"run_id": rid, "task_key": "b", "http_status": 404, "response_text": "gone"}),
    ]


def test_every_order_of_arrival(spark, scratch):
    orders = list(itertools.permutations(range(5)))
    batches = [[records(10 * i)[order[step]] for i, order in enumerate(orders, 1)] for step in range(5)]
    log, waiting, answers = deliver(spark, scratch, batches)
    assert rows_of(log) == rows_of(whole(spark, scratch, batches))
    assert waiting.count() == 0 and answers.count() == 0  # all are complete, nothing is kept


def test_heads_fallbacks_and_generic_rows_are_corrected(spark, scratch):
    page = lambda *ids: (WT.PAGE, {"runs": [run(i) for i in ids]})
    refused = lambda i: (WT.OUTPUT, {"run_id": i, "http_status": 400, "response_text": MULTI})
    batches = [
        [page(1, 2, 3, 4), refused(2), (WT.OUTPUT, {"run_id": 3, "http_status": 500, "response_text": "boom"}),
         (WT.OUTPUT, {"run_id": 4, "http_status": 200, "body": {"error": "get-output error: no output landed"}})],
        [(WT.OUTPUT, {"run_id": 1, "http_status": 200, "body": {"error": "one"}}),
         (WT.DETAILS, {"run_id": 3, "http_status": 200, "body": {"job_name": "three"}})],
        [(WT.DETAILS, {"run_id": 2, "http_status": 200, "body": {"tasks": []}}), page(5)],
    ]
    log, waiting, answers = deliver(spark, os.path.join(scratch, "b"), batches)
    assert rows_of(log) == rows_of(whole(spark, scratch, batches))
    assert [r.run.run_id for r in waiting.collect()] == [5] and answers.count() == 0
    # a repeated batch writes the same; an error text that only looks like a wait is logged once
    table = spark.table("t_waiting")
    first = {r.run_id: r.output_error for r in table.where("version = 0").collect()}
    assert first[1].endswith(FL.NO_OUTPUT) and first[2].endswith(FL.NO_DETAILS)
    assert table.where("run_id = 4").select("version").distinct().count() == 1
    lines = [(k, json.dumps(r)) for k, r in batches[2]]
    WT.advance(spark.createDataFrame(lines, "kind string, value string"), 2, state=WT.State(spark, os.path.join(scratch, "b/state")),
               log_table="t_waiting", now=NOW + timedelta(hours=2))
    spark.catalog.refreshTable("t_waiting")
    assert rows_of(V.resolved_log(spark, "t_waiting")) == rows_of(whole(spark, scratch, batches))


def test_expiry(spark, scratch):
    page = (WT.PAGE, {"runs": [run(1)]})
    late = (WT.OUTPUT, {"run_id": 1, "http_status": 200, "body": {"error": "late"}})
    other = (WT.OUTPUT, {"run_id": 2, "http_status": 200, "body": {"error": "of no run"}})
    log, waiting, answers = deliver(spark, scratch, [[page, other], [], [late]], expiry=timedelta(minutes=30))
    # given up before its output came; the answer that nobody asked for in time is gone, the new one still kept
    assert waiting.count() == 0 and [r.at_run for r in answers.collect()] == [1]
    assert [r.output_error for r in log.collect()] == ["get-output error: no output landed"]


def test_stream_over_three_folders(spark, scratch):
    t = fresh_table(spark, "t_answers")
    for kind in (WT.PAGE, WT.OUTPUT, WT.DETAILS):
        land(f"{scratch}/{kind}/empty.json", [])
    batches = [[records(10)[i], records(30)[4 - i]] for i in range(5)]

    def trigger():
        WT.start_answer_stream(spark, f"{scratch}/page", f"{scratch}/output", f"{scratch}/details", t,
                               checkpoint=f"{scratch}/ck", clock=lambda: NOW).awaitTermination()

    for n, batch in enumerate([batches[0] + batches[1], batches[2] + batches[3] + batches[4]]):
        for m, (kind, record) in enumerate(batch):
            land(f"{scratch}/{kind}/f{n}-{m}.json", [record])
        trigger()
    spark.catalog.refreshTable(t)
    assert rows_of(V.resolved_log(spark, t)) == rows_of(whole(spark, scratch, batches))


def test_bloom_filter_keeps_what_is_looked_up(spark):
    ids = spark.range(0, 40_000, 2).select(F.col("id").alias("run_id"))
    answers = spark.range(0, 200_000).select(F.col("id").alias("at"), F.lit("x").alias("text"))
    kept = looked_up(answers, "at", ids, "run_id")
    found = {r[0] for r in kept.select("at").collect()}
    assert found >= set(range(0, 40_000, 2)) and len(found) <= 1.1 * 20_000
    words = bloom_filter(ids, "run_id")
    assert words.count() <= words.first()["words"] == 20_000 * 24 // 64
    nothing = spark.createDataFrame([(None,)], "run_id long")
    assert probably_in(answers, "at", bloom_filter(nothing, "run_id")).count() == 0


def test_bloom_filters_above_the_bound_are_split(spark, monkeypatch):
    from runlens.operators import bloom
    monkeypatch.setattr(bloom, "MAX_WORDS", 512)
    assert passes_for(None) == 1 and passes_for(4_000) == 3
    ids = spark.range(4_000).select(F.col("id").alias("run_id"))
    answers = spark.range(0, 40_000).select(F.col("id").alias("at"))
    found = {r[0] for r in looked_up(answers, "at", ids, "run_id", expected=4_000).collect()}
    assert found >= set(range(4_000)) and len(found) <= 1.2 * 4_000
    full = {r[0] for r in looked_up(answers, "at", ids, "run_id").collect()}  # too full: more pass, none is lost
    assert full >= set(range(4_000))
