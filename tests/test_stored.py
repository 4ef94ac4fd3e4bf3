"""Rows kept between steps, and the digests of the refreshed summary."""

from datetime import datetime

from pyspark.sql import functions as F

from runlens.operators import failures as FL
from runlens.operators import refresh as REF
from runlens.plans import registry, rules
from runlens.session import stored
from runlens.sources import fixtures as X


def test_stored_rows_are_read_by_column(spark):
    df = spark.sql("select id, string(id) as name, array(id, null) as ids, timestamp_millis(id * 1000 - 60000000000000) as at from range(50) "
                   "union all select null, null, null, null")
    kept = stored(df, "t")
    assert kept.dtypes == df.dtypes and sorted(map(repr, kept.collect())) == sorted(map(repr, df.collect()))
    plan = kept.select("name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan


def test_digests_are_exact_sums_of_whole_hashes(spark):
    names = [c for c in REF.READ if c not in ("job_id", "last_run_end_time")]
    rows = spark.range(400).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 7).alias("job_id"),
        *[F.when(F.col("id") % (i + 2) != 0, F.concat(F.lit(n), F.col("id").cast("string"))).alias(n) for i, n in enumerate(names)],
        F.timestamp_millis(F.col("id") * 1000).alias("last_run_end_time")).select(REF.READ)
    hashes = rows.select("job_id", F.xxhash64(F.lit(1), *REF.READ).alias("a"), F.xxhash64(F.lit(2), *REF.READ).alias("b")).collect()
    want = {}
    for r in hashes:
        n, a, b = want.get(r.job_id, (0, 0, 0))
        want[r.job_id] = (n + 1, a + r.a, b + r.b)
    found = REF.job_digests(rows)
    assert {r.job_id: (r.n_rows, r.digest) for r in found.collect()} == {k: (n, f"{a}:{b}") for k, (n, a, b) in want.items()}
    assert "cast(_1" not in found._jdf.queryExecution().optimizedPlan().toString() and any(a < 0 for _, a, _ in want.values())


def test_summary_refreshed_keeps_no_whole_rows(spark, scratch, monkeypatch):
    """The inventory is derived once, and both inventories are read from it by column."""
    made = []
    rows = spark.sql("select id as job_id, 'etl' as job_name, string(null) as job_tags, concat('t', k) as task_key, 'sql' as task_type, "
                     "'serverless' as cluster_type, '14.3.x' as dbr_version, 'SQL' as notebook_language, "
                     "timestamp_millis(id * 1000) as last_run_end_time, 'unread' as notebook_path from range(1, 90), (select explode(array(1, 2, 3)) as k)")
    monkeypatch.setattr(registry, "inventory_table", lambda *_: made.append(1) or rows)
    found = registry.q_summary_refreshed(spark, scratch)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert made == [1] and "ExistingRDD" not in plan and "notebook_path" not in plan
    want = registry.SUM.job_summary(rows, registry.X.AS_OF)
    assert sorted(map(repr, found.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def driver_tables(spark, folder):
    """Events of every outcome inside and outside the window, and their tasks, some twice or with null keys."""
    n, at = F.col("id"), F.timestamp_seconds(F.lit(1_704_672_000) + F.col("id") * 21_600)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("error", "view", "error", "signup")]), (n % 4 + 1).cast("int"))
    spark.range(80).select(
        n.alias("event_id"), at.alias("ts"), (n % 9).alias("user_id"), kind.alias("event_type"),
        (n / 8).alias("value"), F.format_string('{"k":%d}', (n * 5) % 41).alias("props"),
    ).write.parquet(f"{folder}/events.parquet")
    lines = spark.range(240).select(
        (n % 90).alias("l_orderkey"), (n * 7 % 61).alias("l_partkey"), n.alias("l_suppkey"), (n % 3 + n % 2 + 1).cast("int").alias("l_linenumber"))
    lines.unionByName(lines.where("l_suppkey % 10 = 0").withColumn("l_partkey", F.col("l_partkey") + 3)).unionByName(
        lines.where("l_suppkey < 2").withColumn("l_orderkey", F.lit(None).cast("long"))).write.parquet(f"{folder}/lineitem.parquet")


def test_two_ingests_derive_tasks_details_and_enriched_runs_once(spark, scratch, monkeypatch):
    """Both logs read kept rows: the plan has no scan of the task table and enriches no run; the rows are those of logs derived apart."""
    driver_tables(spark, scratch)
    lo, hi = (int(datetime.fromisoformat(x).timestamp() * 1000) for x in X.WINDOW)
    landed = X.run_records(spark, scratch), X.run_outputs(spark, scratch), X.run_details(spark, scratch)
    a = FL.failure_log(*landed, ingest_iso=X.INGEST_ISO, window=(lo, hi))
    b = FL.failure_log(*landed, ingest_iso=X.REINGEST_ISO)
    made, enrich = [], FL.enrich_runs
    monkeypatch.setattr(FL, "enrich_runs", lambda *args, **named: made.append(1) or enrich(*args, **named))
    found = rules.q_new_only(spark, scratch)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert made == [1, 1] and "l_partkey" not in plan and "end_time#" not in "".join(x for x in plan.splitlines() if "Window" in x)
    want = FL.new_only(b, a, FL.event_key(b))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(found) == rows(want) and a.count() and want.where("child_task_run_id is not null").count()
    assert all(rows(x) == rows(y) for x, y in zip(rules._two_ingests(spark, scratch), (a, b)))
