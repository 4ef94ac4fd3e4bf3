"""What the refreshed summary shuffles and leaves on disk."""

import random
import time

from pyspark.sql import functions as F

from runlens.operators import inventory as INV
from runlens.operators import refresh as REF
from runlens.operators import summary as SUM
from runlens.plans import registry
from runlens.session import SHUFFLE_CLEANUP, stored
from runlens.sources import fixtures as X

AS_OF = "2024-06-01 00:00:00"
SCHEMA = ", ".join(f"{c} {'long' if c == 'job_id' else 'timestamp' if c == 'last_run_end_time' else 'string'}" for c in SUM.READ)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def rows_of(df, columns=None):
    return sorted(map(repr, df.select(columns or df.columns).collect()))


def tasks(seed, jobs=(1, 2, 3, 4, None)):
    """Tasks of jobs whose ids, names, tags and keys repeat or are null."""
    r = random.Random(seed)
    return [(j, r.choice(["a", "b", None, ""]), r.choice(['{"team":"x"}', None]), r.choice(["t1", "t2", "t3", None]),
             r.choice(["notebook", "sql", "spark_jar", "other", "strange", None]), r.choice(["serverless", "none", None]),
             r.choice(["9.1.x", "14.3.x", "custom", None]), r.choice(["PYTHON", "SQL", "Julia", "", None]), None)
            for j in jobs for _ in range(14)]


def job_tables(spark, folder):
    """Orders and their lines, of which some come twice or have null keys, for every kind of task and cluster."""
    n = F.col("id")
    key = lambda by: F.when(n % by != 0, n % 70)
    lines = spark.range(600).select(key(41).alias("l_orderkey"), F.when(n % 43 != 0, n * 7 % 61).alias("l_partkey"),
                                    F.when(n % 47 != 0, n % 29).alias("l_suppkey"), F.when(n % 53 != 0, n % 4 + 1).cast("int").alias("l_linenumber"))
    lines.unionByName(lines.where("l_partkey % 10 = 0")).write.parquet(f"{folder}/lineitem.parquet")
    orders = spark.range(80).select(
        F.when(n % 37 != 5, n).alias("o_orderkey"), (n % 11).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"),
        F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("P")), (n % 3 + 1).cast("int")).alias("o_orderstatus"),
        (n * 1.5).alias("o_totalprice"), F.timestamp_seconds(F.lit(870_000_000) + n * 86_400).alias("o_orderdate"))
    orders.unionByName(orders.where("o_orderkey % 9 = 2")).write.parquet(f"{folder}/orders.parquet")
    spark.range(25).select(n.alias("s_suppkey")).write.parquet(f"{folder}/supplier.parquet")
    spark.range(55).select(n.alias("p_partkey"), (n % 6).cast("int").alias("p_size")).write.parquet(f"{folder}/part.parquet")


def test_stored_leaves_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    kept = stored(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "t")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and spark.conf.get(SHUFFLE_CLEANUP, None) == was
    assert rows_of(kept) == rows_of(spark.range(10).select(F.col("id").alias("k"), F.lit(100).alias("count")))


def test_summary_is_dealt_once_and_as_stored(spark):
    """One shuffle, of the columns that the summary reads."""
    rows = stored(spark.createDataFrame(tasks(0), SCHEMA), "t")
    dealt = plan(SUM.job_summary(rows, AS_OF)).split("Exchange ")
    assert len(dealt) == 2 and "FileScan" in dealt[1] and "Project" not in dealt[1]


def test_distinct_task_keys_of_jobs_that_share_an_id(spark):
    for seed in range(3):
        rows = tasks(seed)
        keys = {}
        for r in rows:
            keys.setdefault(r[:3], set()).update({r[3]} - {None})
        found = SUM.job_summary(spark.createDataFrame(rows, SCHEMA), AS_OF).collect()
        assert {(r.job_id, r.job_name, r.job_tags): r.num_tasks for r in found} == {k: len(v) for k, v in keys.items()} and len(found) == len(keys)


def test_digests_are_not_shuffled_again(spark):
    rows = stored(spark.createDataFrame(tasks(0), SCHEMA), "t")
    found = REF.changed_jobs(REF.job_digests(rows), REF.job_digests(rows.where("job_id <> 2 or job_id = 2 and task_key = 't1'")))
    assert plan(found).count("Exchange ") == 2
    assert {(r.job_id, r.change) for r in found.collect()} == {(2, "edited"), (None, "deleted")}


def test_refreshed_with_null_ids(spark):
    for old, new in ((tasks(1), tasks(1)), (tasks(1), tasks(2)), (tasks(1, (1, 2)), tasks(1)), (tasks(1), tasks(2, (1, 2)))):
        old, new = (spark.createDataFrame(x, SCHEMA) for x in (old, new))
        found = REF.refreshed_summary(SUM.job_summary(old, AS_OF), REF.job_digests(old), new, AS_OF)
        assert rows_of(found) == rows_of(SUM.job_summary(new, AS_OF), found.columns)


def test_kept_inventory_looks_up_only_rows_that_ask(spark, scratch):
    job_tables(spark, scratch)
    sources = [f(spark, scratch) for f in (X.jobs, X.clusters, X.workspace_objects, X.job_runs)]
    names, sizes = [], []

    def keep(df, name):
        names.append(name)
        sizes.append(df.count())
        return stored(df, name)
    want, found = INV.job_inventory(*sources, True), INV.job_inventory(*sources, True, keep)
    assert rows_of(found) == rows_of(want) and found.schema.names == want.schema.names
    assert names == ["task-rows", "looked-up"] and 0 < sizes[1] < sizes[0] * 0.6 and sizes[0] == want.count()
    assert want.where("notebook_language is not null").count() and want.where("cluster_type = 'interactive' and dbr_version is not null").count()


def test_lines_are_dealt_before_they_are_tasks(spark, scratch):
    job_tables(spark, scratch)
    lines = X.jobs(spark, scratch)._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert len(lines) == 2 and "task_key" in lines[0] and "task_key" not in lines[1]


def test_refreshed_summary_of_whole_tables(spark, scratch):
    job_tables(spark, scratch)
    found = registry.q_summary_refreshed(spark, scratch)
    want = registry.q_job_summary(spark, scratch)
    assert rows_of(found) == rows_of(want, found.columns) and want.count() > 70
    assert "l_partkey" not in found._jdf.queryExecution().optimizedPlan().toString()  # jobs are derived once
