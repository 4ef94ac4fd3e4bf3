"""Spread lookup keys, one answer per key, lineage cut before a self-overwrite, cost key parity."""
from pyspark.sql import functions as F

from runlens.operators import joins as JN
from runlens.operators import ownership as OWN
from runlens.session import cut_lineage
from runlens.sinks import tables as K


def test_null_lookup_keys_are_spread(spark):
    """Rows without a key do not meet in one partition of a shuffle join."""
    rows = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("k"), F.col("id") % 400)).alias("key"))
    dealt = rows.withColumn("key", JN.spread_key(F.col("key"), "id")).repartition(8, "key")
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8
    lookup = spark.createDataFrame([("k0", "x"), ("", "y")], "key string, v string")
    found = rows.withColumn("key", JN.spread_key(F.col("key"), "id")).join(lookup, "key", "left").where("v is not null")
    assert found.count() == 10


def test_latest_keeps_one_row_per_key(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (None, 1, "e")], "k long, at long, v string")
    out = JN.latest(rows, ["k"], [F.col("at").desc_nulls_last()]).collect()
    assert sorted((r.k or 0, r.v) for r in out) in ([(0, "e"), (1, "b"), (2, "d")], [(0, "e"), (1, "c"), (2, "d")])
    assert out[0].asDict().keys() == {"k", "at", "v"}


def test_unique_lookup_never_multiplies_rows(spark):
    lk = spark.createDataFrame([("a", "1"), ("a", "2"), (None, "3")], "k string, v string")
    out = {r.k: r.v for r in JN.unique_lookup(lk, "k", "v").collect()}
    assert out == {"a": "2"}


def test_replace_table_from_itself_after_lineage_cut(spark):
    spark.sql("DROP TABLE IF EXISTS t_self")
    spark.range(5).withColumn("x", F.col("id") * 2).write.saveAsTable("t_self")
    doubled = cut_lineage(spark.table("t_self").withColumn("x", F.col("x") * 2))
    K.replace_table(doubled, "t_self")
    spark.catalog.refreshTable("t_self")
    assert sorted(r.x for r in spark.table("t_self").collect()) == [0, 4, 8, 12, 16]


def test_cost_join_key_parity(spark):
    summary = spark.createDataFrame([(7, "nightly", "Y"), (8, "null", "Y"), (9, "other", "N")],
                                    "job_id bigint, job_name string, ran_last_6_months string")
    tracker = OWN.project_tracker(spark.createDataFrame(
        [("Nightly ", "p", "t", "m", True), ("null", "p", "t", "m", True), ("other", "p", "t", "m", True)],
        "job_name string, project_name string, tower_owner string, manager string, is_active boolean"))
    cost = spark.createDataFrame([("7",), ("nightly",)], "jobid string")
    by_id = OWN.migration_list(summary, tracker, cost).collect()
    by_name = OWN.migration_list(summary, tracker, cost, cost_key="job_name").collect()
    assert [(r.job_id, r.jobid) for r in by_id] == [(7, "7")]
    assert [(r.job_id, r.jobid) for r in by_name] == [(7, "nightly")]
