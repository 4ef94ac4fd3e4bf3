"""Plan hygiene and oracle agreement on the smallest scale factor."""
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from runlens.plans import registry
from runlens.sources import fixtures as X

SF = "/root/testdata/sf0.001"
HEADLINE = ["failure_log", "job_inventory", "job_summary", "migration_list"]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEADLINE)
def test_no_python_udf(spark, name):
    p = plan_text(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_task_rows_do_not_carry_their_jobs_settings(spark):
    generate = [x for x in optimized(E.queries()["job_inventory"](spark, SF)).splitlines() if "Generate explode" in x]
    assert len(generate) == 1 and "settings" not in generate[0]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_only_the_merge_per_job_gathers_lists(spark):
    """Counters per language and version are kept in place; two object aggregates, partial and final, gather the rest
    (and two the tasks of the job definitions)."""
    assert plan_text(E.queries()["job_summary"](spark, SF)).count("ObjectHashAggregate") == 4


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
@pytest.mark.parametrize("shape", ["jobs", "run_details"])
def test_nested_tasks_are_sorted_and_taken_without_lambdas(spark, shape):
    plan = optimized(getattr(X, shape)(spark, SF))
    assert "sort_array" in plan and "lambdafunction" not in plan


def test_every_query_has_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_text_operators(scratch):
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copy(E.__file__, scratch)
    shutil.copytree(f"{root}/runlens", f"{scratch}/runlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    names = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"],
                           cwd=scratch, env=os.environ | {"PYTHONPATH": scratch}, capture_output=True, text=True, check=True).stdout
    assert names.splitlines() == [" ".join(sorted(registry.QUERIES)), " ".join(sorted(registry.ORACLE))]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return f"{v:.6f}"
    return str(v)


def _rows(rows):
    return sorted(tuple(_norm(v) for v in r) for r in rows)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_oracle_agreement(spark, name):
    con = duckdb.connect()
    for t in ["customer", "supplier", "part", "orders", "lineitem", "events", "documents"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    duck = [tuple(r[i] for i in order) for r in res.fetchall()]
    assert _rows(df.collect()) == _rows(duck)
