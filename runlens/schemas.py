"""Payload and table schemas.

Payload fields that the rules test for *key presence* are kept as raw JSON
text (STRING): Spark's JSON reader stores an object value read into a STRING
field as its text, so ``json_object_keys`` can still see explicit nulls.
Integers that must be parsed leniently (attempt numbers, original ids) are
read as text too.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from .functions.jobs import JOB_TASK_KINDS
from .functions.runs import RUN_TASK_KINDS

S, L, B = StringType(), LongType(), BooleanType()


def _st(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


RUN_STATE = _st(("life_cycle_state", S), ("result_state", S), ("state_message", S))

_RUN_FIELDS = (
    ("run_id", L), ("job_id", L), ("run_name", S), ("run_page_url", S),
    ("start_time", L), ("end_time", L), ("attempt_number", S), ("run_attempt", S), ("original_attempt_run_id", S),
)
# The listing request that a page answers, landed beside the answer (optional): its window and the token of the page.
PAGE_REQUEST = (("start_time_from", L), ("start_time_to", L), ("page_token", S), ("landed_at", L))
# A page's entries keep the state object as text; the reader adds its typed fields.
RUN_PAGE = _st(("runs", ArrayType(_st(*_RUN_FIELDS, ("state", S)))), ("has_more", B), ("next_page_token", S),
               *PAGE_REQUEST)
RUN = _st(*_RUN_FIELDS, ("state_raw", S), ("state", RUN_STATE))

TERMINATION = _st(("code", S), ("type", S), ("reason", S))
OUTPUT_STATE = _st(
    ("life_cycle_state", S), ("state", S), ("result_state", S), ("state_message", S),
    ("termination_details", TERMINATION),
)
# Kind fields as text, and the payload's own keys: a kind that is there with a null value counts as present.
_KIND_RAW = [(k, S) for k in RUN_TASK_KINDS] + [("payload_keys", ArrayType(S))]

OUTPUT_METADATA = _st(
    ("job_id", L), ("job_name", S), ("run_name", S), ("run_page_url", S),
    ("start_time", L), ("end_time", L), ("attempt_number", S), ("task", S),
    ("state", OUTPUT_STATE), ("status", OUTPUT_STATE), *_KIND_RAW,
)
# `landed_at` (epoch ms, optional) tells later landings of one answer from earlier ones.
_ANSWER = (("http_status", IntegerType()), ("response_text", S), ("landed_at", L))
OUTPUT_BODY = _st(("error", S), ("metadata", OUTPUT_METADATA))
RUN_OUTPUT = _st(("run_id", L), ("task_key", S), *_ANSWER, ("body", OUTPUT_BODY))
RUN_OUTPUT_LANDED = _st(("run_id", L), ("task_key", S), *_ANSWER, ("body", S))

DETAIL_TASK = _st(("task_key", S), ("run_id", L), ("task_run_id", L), ("task", S), *_KIND_RAW)
_DETAIL_FIELDS = (("job_id", L), ("job_name", S), ("attempt_number", S), ("original_attempt_run_id", S), ("task", S),
                  *_KIND_RAW)
# The tasks of a landed body stay text, one element each, until their own keys are read.
DETAIL_BODY_LANDED = _st(*_DETAIL_FIELDS, ("tasks", ArrayType(S)))
RUN_DETAILS = _st(("run_id", L), *_ANSWER, ("body", _st(*_DETAIL_FIELDS, ("tasks", ArrayType(DETAIL_TASK)))))
RUN_DETAILS_LANDED = _st(("run_id", L), *_ANSWER, ("body", S))

SPARK_VERSION = _st(("spark_version", S))
JOB_TASK = _st(
    ("task_key", S), ("job_cluster_key", S), ("existing_cluster_id", S), ("environment_key", S),
    ("new_cluster", SPARK_VERSION), ("notebook_task", _st(("notebook_path", S))),
    *[(f"{k}_task", S) for k in JOB_TASK_KINDS if k != "notebook"],
)
JOB = _st(
    ("job_id", L),
    ("settings", _st(
        ("name", S), ("tags", MapType(S, S)),
        ("job_clusters", ArrayType(_st(("job_cluster_key", S), ("new_cluster", SPARK_VERSION)))),
        ("tasks", ArrayType(JOB_TASK)),
    )),
)

CLUSTERS = _st(("cluster_id", S), ("spark_version", S))
WORKSPACE_OBJECTS = _st(("path", S), ("language", S))
JOB_RUNS = _st(
    ("job_id", L), ("run_id", L), ("start_time", L), ("end_time", L),
    ("state", _st(("result_state", S), ("life_cycle_state", S))),
)
CROSSWALK = _st(("job_name", S), ("project_name", S), ("tower_owner", S), ("manager", S), ("is_active", B))
JOB_COST = _st(("jobid", S))

# Failure log: 24 row fields in table order, then the ingest stamp.
FAILURE_FIELDS = [
    ("job_id", "bigint"), ("run_id", "bigint"), ("job_name", "string"), ("run_name", "string"),
    ("run_page_url", "string"), ("child_task_run_id", "bigint"), ("child_task_key", "string"),
    ("task_type", "string"), ("job_start_datetime_iso", "string"), ("job_end_datetime_iso", "string"),
    ("duration_ms", "bigint"), ("life_cycle_state", "string"), ("result_state", "string"),
    ("state_message", "string"), ("termination_code", "string"), ("termination_type", "string"),
    ("termination_reason", "string"), ("output_error", "string"), ("is_retry", "boolean"),
    ("attempt_number", "bigint"), ("original_attempt_run_id", "bigint"), ("error_category", "string"),
    ("error_provider", "string"), ("error_message_short", "string"),
]
FAILURE_LOG_FIELDS = FAILURE_FIELDS + [("row_added_at", "string")]


def ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t.upper()}" for n, t in fields)


_TYPES = {"bigint": L, "string": S, "boolean": B}
FAILURE_LOG = StructType([StructField(n, _TYPES[t], True) for n, t in FAILURE_LOG_FIELDS])

DEBUG_ROWS = _st(
    ("job_id", L), ("run_id", L), ("state_json", S), ("run_name", S), ("run_page_url", S),
    ("workspace_host", S), ("ingest_iso", S),
)

WATERMARK = _st(("id", S), ("last_run_iso", S), ("updated_at", S))
