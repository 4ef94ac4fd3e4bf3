"""Unit rows of FIXTURES.md §2 for the run-side rules."""
import pytest
from pyspark.sql import functions as F

from runlens.functions import common as C
from runlens.functions import runs as R


def vals(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_lenient_int(spark):
    assert vals(spark, C.lenient_int, ["7", " 12 ", "1_000", "1.9", "x", None, "+5", "1__0", "true"]) == \
        [7, 12, 1000, None, None, None, 5, None, 1]


def test_iso_utc(spark):
    assert vals(spark, C.iso_utc, [1758717296000, 1758717296789, 0, None], "bigint") == [
        "2025-09-24T12:34:56+00:00", "2025-09-24T12:34:56.789000+00:00", None, None]


def test_duration(spark):
    df = spark.createDataFrame([(1000, 3500), (0, 5), (5, 0), (None, 4)], "s bigint, e bigint")
    assert [r[0] for r in df.select(C.duration_ms("s", "e")).collect()] == [2500, None, None, None]


def test_duration_seconds_half_up(spark):
    df = spark.createDataFrame([(0, 50), (0, 149), (0, 150), (0, 1234)], "s bigint, e bigint")
    # start 0 is falsy, so shift by a second
    df = df.select((F.col("s") + 1000).alias("s"), (F.col("e") + 1000).alias("e"))
    assert [r[0] for r in df.select(C.duration_seconds_1dp("s", "e")).collect()] == [0.1, 0.1, 0.2, 1.2]


@pytest.mark.parametrize("text,ms", [
    ("2025-09-24T12:34:56Z", 1758717296000),
    ("2025-09-24 12:34:56", 1758717296000),
    ("2025-09-24", 1758672000000),
    ("2025-09-24T12:34:56+02:00", 1758717296000 - 7_200_000),
    ("2025-09-24T12:34:56.7899", 1758717296789),
    ("2025", None), ("12:00", None), ("2025-09-24 12:00:00-02:00", None), ("Tuesday", None),
    ("20250924T123456", 1758717296000), ("2025-09-24T12.5", 1758715200500),
    ("2025-09-24+02:00", 1758679200000),  # '+' read as the date/time separator, as Python does
    ("2025-09-24Z", 1758672000000), ("2025-09-24T12:34:56.1234567", 1758717296123),
])
def test_to_epoch_ms(spark, text, ms):
    assert vals(spark, C.to_epoch_ms, [text]) == [ms]
    if ms is None:
        with pytest.raises(ValueError):
            C.to_epoch_ms_strict(text)
    else:
        assert C.to_epoch_ms_strict(text) == ms


def test_error_fields(spark):
    texts = [None, "", "  ", "x not_found", "TIMEOUT INTERNAL_ERROR", "digit", "unstable", "git table",
             "a\nb", "y" * 300]
    cat = vals(spark, R.error_category, texts)
    prov = vals(spark, R.error_provider, texts)
    short = vals(spark, R.error_short, texts)
    assert cat == [None, None, None, "NOT_FOUND", "INTERNAL_ERROR", None, None, None, None, None]
    assert prov == [None, None, None, None, None, "GIT", "UNITY_CATALOG", "GIT", None, None]
    assert short[:3] == [None, None, ""]
    assert short[8] == "a b" and len(short[9]) == 240


@pytest.mark.parametrize("payload,kind", [
    ('{"sql_task":null}', "sql_task"),
    ('{"task":{"dbt_task":{}},"sql_task":{}}', "dbt_task"),
    ('{"task":{},"sql_task":{}}', "sql_task"),
    ('{"spark_python_task":{},"spark_jar_task":{}}', "spark_jar_task"),
    ('{"other":1}', None),
    ('{"task":{"x":1},"sql_task":{}}', None),
])
def test_infer_task_type(spark, payload, kind):
    df = spark.createDataFrame([(payload,)], "p string")
    got = df.select(R.infer_task_type(R.raw_keys("p"), F.get_json_object("p", "$.task"))).first()[0]
    assert got == kind


def test_infer_task_type_parses_a_payload_once(spark):
    df = spark.createDataFrame([('{"sql_task":{}}',), (None,)], "p string")
    out = df.select(R.infer_task_type(R.raw_keys("p"), F.get_json_object("p", "$.task")).alias("kind"))
    assert [r.kind for r in out.collect()] == ["sql_task", None]
    project = out._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert project.count("p#") == 2  # its own keys and its task, where each kind read both again


def test_retry_fields(spark):
    rows = [("0", "0", None, "2", None, None, 7),      # an attempt > 0
            (None, None, None, None, None, "5", 5),    # original equals run
            (None, None, None, None, None, "5", 6),    # original differs
            (None, None, None, None, "0", "5", 6)]     # details 0 falls through
    df = spark.createDataFrame(rows, "m string, d string, a string, b string, do string, ro string, rid bigint")
    out = df.select(
        R.is_retry([F.col("m"), F.col("d"), F.col("a"), F.col("b")], [F.col("do"), F.col("ro")], F.col("rid")),
        R.attempt_number(F.col("m"), F.col("d"), F.col("a"), F.col("b")),
        R.original_attempt_run_id(F.col("do"), F.col("ro")),
    ).collect()
    assert [r[0] for r in out] == [True, False, True, True]
    assert [r[1] for r in out] == [0, None, None, None]
    assert [r[2] for r in out] == [None, 5, 5, 0]


def test_attempt_number_first_parseable(spark):
    df = spark.createDataFrame([(None, "0", "3", "4")], "a string, b string, c string, d string")
    assert df.select(R.attempt_number(*[F.col(c) for c in "abcd"])).first()[0] == 0
