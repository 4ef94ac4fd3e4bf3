"""Incremental summary, joins split on both sides, Z-ordered log."""
import random

from pyspark.sql import functions as F

from runlens.operators import joins as JN
from runlens.operators import refresh as REF
from runlens.operators import summary as SUM
from runlens.sinks import zorder as Z

AS_OF = "2024-06-01 00:00:00"
INVENTORY = ("job_id long, job_name string, job_tags string, task_key string, task_type string, cluster_type string, "
             "dbr_version string, notebook_language string, last_run_end_time timestamp")


def inventory(spark, rows):
    df = spark.createDataFrame([(*r, "2024-05-01 00:00:00" if (r[0] or 0) % 2 else None) for r in rows],
                               INVENTORY.replace("last_run_end_time timestamp", "ended string"))
    return df.withColumn("last_run_end_time", F.to_timestamp("ended")).drop("ended")


def task(job, n, kind="notebook", version="14.3.x", language="PYTHON"):
    return (job, None if job is None else f"name {job}", '{"team":"a"}' if (job or 0) % 3 else None, f"t{n}", kind, "serverless", version, language)


def summary_rows(df):
    return sorted(map(repr, df.select(SUM.summary_columns()).collect()))


def test_refreshed_summary(spark):
    before = [task(j, n) for j in (1, 2, 3, 4, 5, None) for n in range(3)]
    after = [r for r in before if r[0] not in (2,)]                        # job 2 is gone
    after.remove(task(3, 1))                                               # a task of job 3 too
    after = [task(4, 0, "sql", "9.1.x", "SQL") if r == task(4, 0) else r for r in after]  # edited: minimum and vote change
    after += [task(6, 0), task(5, 2)]                                      # a new job, a row twice
    old, new = inventory(spark, before), inventory(spark, after)
    digests = REF.job_digests(old)
    changes = {(r.job_id, r.change) for r in REF.changed_jobs(digests, REF.job_digests(new)).collect()}
    assert changes == {(2, "deleted"), (3, "edited"), (4, "edited"), (5, "edited"), (6, "inserted")}
    found = REF.refreshed_summary(SUM.job_summary(old, AS_OF), digests, new, AS_OF)
    assert summary_rows(found) == summary_rows(SUM.job_summary(new, AS_OF))
    assert REF.changed_jobs(digests, REF.job_digests(old.orderBy(F.rand(1)))).isEmpty()  # order makes no difference
    same = REF.refreshed_summary(SUM.job_summary(old, "2025-06-01 00:00:00"), digests, old, AS_OF)
    assert summary_rows(same) == summary_rows(SUM.job_summary(old, AS_OF))  # the recency flag is of the day


def test_votes_add_up_over_versions(spark):
    rows = [task(1, n, "spark_python", version) for n, version in enumerate(["9.1.x", "9.1.x", "10.4.x", None])]
    rows += [task(1, 8, "sql", "9.1.x"), *[task(2, n, "sql", f"{n}.0") for n in range(2)], task(2, 7, "spark_python", "1.0")]
    found = {r.job_id: (r.job_language, r.num_tasks, r.dbr_version_count) for r in SUM.job_summary(inventory(spark, rows), AS_OF).collect()}
    assert found == {1: ("mostly_python", 5, 2), 2: ("python_and_sql", 3, 2)}


def test_unchanged_jobs_are_not_summed_up_again(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(REF, "job_summary", lambda rows, as_of: seen.append({r.job_id for r in rows.collect()}) or SUM.job_summary(rows, as_of))
    rows = [task(j, n) for j in range(20) for n in range(2)]
    old = inventory(spark, rows)
    REF.refreshed_summary(SUM.job_summary(old, AS_OF), REF.job_digests(old), inventory(spark, [*rows, task(7, 9)]), AS_OF)
    assert seen == [{7}]


def test_counters_are_corrected_by_changed_rows_alone(spark):
    rng = random.Random(2)
    kinds = ["notebook", "sql", "dbt", None]
    rows = [task(j, n, rng.choice(kinds), language=rng.choice(["SQL", "R", None])) for j in range(12) for n in range(4)]
    left = [r for r in rows if rng.random() < 0.2] + [r for r in rows if r[0] == 11]
    left = list(dict.fromkeys(left))
    came = [task(j, 90, rng.choice(kinds)) for j in (3, 3, 20)]
    stay = [r for r in rows if r not in left] + came
    found = REF.corrected_counters(REF.counters(inventory(spark, rows)), inventory(spark, left), inventory(spark, came))
    want = REF.counters(inventory(spark, stay))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    pivots = SUM.job_pivots(SUM.job_summary(inventory(spark, stay), AS_OF))
    assert sorted(map(repr, found.select(pivots.columns).collect())) == sorted(map(repr, pivots.collect()))


def test_split_join_is_the_join_and_no_group_is_large(spark):
    left = spark.range(4000).select(F.col("id").alias("a"), F.when(F.col("id") % 2 == 0, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"))
    right = spark.range(300).select(F.col("id").alias("b"), F.when(F.col("id") < 100, "hot").when(F.col("id") < 110, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 60).cast("string"))).alias("k"))
    right = right.unionByName(right.where("b < 3"))  # repeated rows stay repeated
    found = JN.split_join(left, right, "k", heavy_rows=40)
    want = left.join(right, "k")
    assert found.columns == want.columns
    key = ["k", "a", "b"]
    assert found.groupBy(key).count().exceptAll(want.groupBy(key).count()).isEmpty() and found.count() == want.count()
    heavy = JN.heavy_keys(left, right, "k", heavy_rows=40)
    assert {r.k for r in heavy.collect()} >= {"hot"}
    groups = JN.dealt(left, heavy, "k", "lefts", "rights").groupBy("k", "_lefts", "_rights").count()
    sizes = sorted(r["count"] for r in groups.collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]  # one name on half of all rows: the largest group below twice the median
    plain = [r.k for r in JN.heavy_keys(left, right, "k").collect()]
    assert plain == []  # nothing heavy by the default bound


def test_z_order_reads_a_quarter_of_the_files_for_each_id(spark, scratch):
    rng = random.Random(1)
    rows = [(rng.randrange(10**6), rng.randrange(10**9), rng.randrange(10**9) if rng.random() < 0.8 else None, f"x{i}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "job_id long, run_id long, child_task_run_id long, text string")
    Z.write_z_ordered(df, f"{scratch}/log", files=64)
    files = Z.file_bounds(spark, f"{scratch}/log")
    n = files.count()
    assert 48 <= n <= 128 and files.agg(F.max("n_rows")).first()[0] <= 4 * len(rows) / n and files.agg(F.sum("n_rows")).first()[0] == len(rows)
    for k, column in enumerate(Z.IDS):
        for row in rows[5:400:40]:
            if row[k] is None:
                continue
            hits = Z.matching_files(spark, f"{scratch}/log", column, row[k], row[k])
            assert 1 <= len(hits) <= n / 4
        found = Z.read_pruned(spark, f"{scratch}/log", column, rows[45][k]).collect() if rows[45][k] is not None else []
        assert sorted(map(tuple, found), key=str) == sorted((r for r in rows if rows[45][k] is not None and r[k] == rows[45][k]), key=str)
    span = Z.read_pruned(spark, f"{scratch}/log", "run_id", 10**8, 2 * 10**8)
    assert span.count() == sum(10**8 <= r[1] <= 2 * 10**8 for r in rows)
    assert Z.read_pruned(spark, f"{scratch}/log", "job_id", -5).count() == 0


def test_z_order_of_one_value_nulls_and_nothing(spark, scratch):
    schema = "job_id long, run_id long, child_task_run_id long"
    same = spark.createDataFrame([(1, i, None) for i in range(100)], schema)
    Z.write_z_ordered(same, f"{scratch}/same", files=4)
    assert Z.read_pruned(spark, f"{scratch}/same", "run_id", 7).count() == 1
    assert Z.read_pruned(spark, f"{scratch}/same", "child_task_run_id", 7).count() == 0
    Z.write_z_ordered(spark.createDataFrame([], schema), f"{scratch}/none", files=4)
    assert Z.read_pruned(spark, f"{scratch}/none", "job_id", 1).count() == 0
