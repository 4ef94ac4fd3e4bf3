"""Unit rows of FIXTURES.md §2 for the job-side rules."""
from datetime import datetime

from pyspark.sql import functions as F

from runlens.functions import jobs as J
from runlens.operators import ownership as OWN
from runlens.operators.summary import job_summary


def test_notebook_name(spark):
    df = spark.createDataFrame([("/a/b",), ("b",), ("/a/",), (None,)], "p string")
    assert [r[0] for r in df.select(J.notebook_name("p")).collect()] == ["b", "b", "", None]


def test_extract_tag(spark):
    df = spark.createDataFrame([
        ({"Cost-Center": "x"},), ({"team": "b", "Supporting Team": "a"},),
        ({"supporting team": "", "team": "b"},), ({"Team": "x", "team": "y"},), ({},)],
        "m map<string,string>")
    assert [r[0] for r in df.select(J.extract_tag(F.col("m"), J.TAG_VARIANTS["cost_center"])).collect()][:1] == ["x"]
    team = [r[0] for r in df.select(J.extract_tag(F.col("m"), J.TAG_VARIANTS["supporting_team"])).collect()]
    assert team[1:] == ["a", None, "y", None]


def test_parse_tags_legacy_literal(spark):
    df = spark.createDataFrame([("{'a': 'b', 'c': None}",), ("not tags",), (None,)], "t string")
    out = [r[0] for r in df.select(J.parse_tags("t")).collect()]
    assert out[0] == {"a": "b", "c": None} and out[1] == {} and out[2] == {}


def test_version_and_min(spark):
    df = spark.createDataFrame([("14.3.x-scala2.12",), ("custom:x",)], "v string")
    k = [r[0] for r in df.select(J.version_key("v")).collect()]
    assert (k[0].major, k[0].minor) == (14, 3) and k[1] is None


def test_job_name_issues(spark):
    names = ["my_dev_job", "my-dev", "x_v12", "New Job 3", None, "orders", "", "n dev"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = df.select(J.job_name_flag("n"), J.job_name_issues("n")).collect()
    assert [r[1] for r in out] == ["personal", "env:dev, personal", "copy", "unnamed", "unnamed", None,
                                   "unnamed", "env:dev"]
    assert [r[0] for r in out][:6] == ["Y", "Y", "Y", "Y", "Y", "N"]


def test_task_language(spark):
    rows = [("sql", None), ("pipeline", None), ("notebook", "PYTHON"), ("notebook", None), ("spark_jar", None)]
    df = spark.createDataFrame(rows, "t string, l string")
    out = [r[0] for r in df.select(J.task_language(F.col("t"), F.col("l"))).collect()]
    assert out == ["sql", None, "python", None, "investigation_needed"]


def test_recency(spark):
    df = spark.createDataFrame([(datetime(2025, 2, 28, 10),), (datetime(2025, 2, 28, 9, 59, 59),), (None,)],
                               "e timestamp")
    out = [r[0] for r in df.select(J.recency_flag(F.col("e"), F.lit("2025-08-31 10:00:00").cast("timestamp"))).collect()]
    assert out == ["Y", "N", "N"]


def _inventory(spark, rows):
    schema = ("job_id bigint, job_name string, job_tags string, task_key string, task_type string, "
              "cluster_type string, dbr_version string, notebook_language string, last_run_end_time timestamp")
    return spark.createDataFrame(rows, schema)


def test_job_language_vote(spark):
    def job(jid, kinds):
        return [(jid, f"j{jid}", None, f"t{i}", t, "serverless", None, lang, None) for i, (t, lang) in enumerate(kinds)]
    py, sq = ("spark_python", None), ("sql", None)
    rows = (job(1, [py] * 4 + [sq]) + job(2, [py] * 3 + [sq]) + job(3, [py, sq, ("notebook", "SCALA")])
            + job(4, [py, ("spark_jar", None)]) + job(5, [("spark_jar", None)]) + job(6, [("pipeline", None)]))
    out = {r.job_id: r.job_language for r in job_summary(_inventory(spark, rows), "2025-01-01").collect()}
    assert out == {1: "mostly_python", 2: "python_and_sql", 3: "mixed", 4: "python_needs_investigation",
                   5: "no_language_tasks_needs_investigation", 6: "no_language_tasks"}


def test_summary_of_job_without_tasks_and_versions(spark):
    rows = [(7, "x", None, None, None, None, None, None, None),
            (8, "y", '{"team":"a"}', "t1", "notebook", "job_cluster", "10.4.x", "PYTHON", None),
            (8, "y", '{"team":"a"}', "t1", "sql", "job_cluster", "9.1.x", None, None)]
    out = {r.job_id: r for r in job_summary(_inventory(spark, rows), "2025-01-01").collect()}
    r = out[7]
    assert (r.num_tasks, r.task_other, r.compute_unknown, r.investigation_needed, r.job_language) == \
        (0, 1, 1, "N", "no_language_tasks")
    r = out[8]
    assert (r.num_tasks, r.task_notebook, r.task_sql, r.lang_python) == (1, 1, 1, 1)   # N12
    assert (r.dbr_versions, r.min_dbr_version, r.dbr_version_count, r.supporting_team) == \
        ("10.4.x, 9.1.x", "9.1.x", 2, "a")


def test_tracker(spark):
    rows = [("a", " p ", None, "m", True), ("b", None, "t", "Untagged", True), ("c", None, None, "m", True),
            ("d", "x", "t", "m", False)]
    df = spark.createDataFrame(rows, "job_name string, project_name string, tower_owner string, manager string, "
                                     "is_active boolean")
    out = {r.job_name: r for r in OWN.project_tracker(df).collect()}
    assert set(out) == {"a", "b", "c"}
    assert (out["a"].tower_owner, out["a"].manager, out["a"].project_name) == ("Untagged", "a", "p")
    assert out["b"].manager == "b" and out["c"].manager == "c" and out["b"].project_name == "Untagged"


def test_cluster_type_and_runtime_version(spark):
    from runlens.schemas import JOB_TASK
    rows = [
        {"task_key": "a", "run_job_task": "{}", "job_cluster_key": "k"},
        {"task_key": "b", "spark_jar_task": "{}", "job_cluster_key": "k", "existing_cluster_id": "c"},
        {"task_key": "c", "spark_jar_task": "{}"},
        {"task_key": "d", "notebook_task": {"notebook_path": None}},
        {"task_key": "e", "spark_jar_task": "{}", "environment_key": "env"},
        {"task_key": "f", "spark_jar_task": "{}", "new_cluster": {"spark_version": "15.4.x"}},
    ]
    df = spark.createDataFrame([(r,) for r in rows], f"t {JOB_TASK.simpleString()}")
    t = F.col("t")
    ttype = J.task_type(t)
    jcs = F.array(F.struct(F.lit("k").alias("job_cluster_key"),
                           F.struct(F.lit("13.3.x").alias("spark_version")).alias("new_cluster")))
    out = df.select(ttype.alias("ty"), J.cluster_type(t, ttype).alias("ct"),
                    J.runtime_version(t, J.shared_cluster_version(jcs, t.getField("job_cluster_key")),
                                      F.lit("9.1.x")).alias("v")).collect()
    assert [r.ty for r in out] == ["run_job", "spark_jar", "spark_jar", "notebook", "spark_jar", "spark_jar"]
    assert [r.ct for r in out] == ["none", "job_cluster", "unknown", "serverless", "serverless", "job_cluster"]
    assert [r.v for r in out] == ["13.3.x", "13.3.x", None, None, None, "15.4.x"]


def test_parse_tags_reads_json_and_literals(spark):
    texts = {
        '{"note":"x: None, y","a":null}': {"note": "x: None, y", "a": None},
        "{'application': True, 'b': None, 'c': 'it is None, True'}": {"application": "True", "b": None, "c": "it is None, True"},
        "{'a': \"it's None\", 'n': False}": {"a": "it's None", "n": "False"},
        "not tags": {}, "": {}, None: {},
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(J.parse_tags("t")).collect()] == list(texts.values())


def test_parse_tags_agrees_with_python_on_generated_dicts(spark):
    import ast
    import random

    rng = random.Random(5)
    alphabet = ["a", "B", " ", "'", '"', "\\", "\n", "\t", "\x07", "\xa0", "é", "€", "\x00", "\x02", "😀", "None", "True", ",", ":", "{", "}", "\x7f", "\u2028"]
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(rng.randrange(n)))
    texts = [repr({word(6) or "k": word(9) for _ in range(rng.randrange(1, 5))}) for _ in range(400)]
    texts += [r"{'a': '\x41\101\u0042\U0001F600\'\"\\'}", r"{'a': r'\x41', u'b': 'x' 'y',}", r"{'o': '\0\08\777', 'q': '\q\d'}",
              "{'a': 'one \\\ntwo'}", "{}", "{'a': ''}", "{'a': '', 'b': ''}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: r.m for r in df.select("i", J.parse_tags("t").alias("m")).collect()}
    for i, text in enumerate(texts):
        assert found[i] == ast.literal_eval(text), text
    bad = ["{'a': ", "{'a' 'b'}", "$", "{'a': 'b'} x", "{'a': '\\ud800'}", "{'a': '\\U00110000'}", None]
    df = spark.createDataFrame([(t,) for t in bad], "t string")
    assert [r[0] for r in df.select(J.parse_tags("t")).collect()] == [{}, {}, {}, {}, {"a": "\ufffd"}, {"a": "\ufffd"}, {}]
