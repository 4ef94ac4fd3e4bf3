"""Column rules for failed runs: task kind, retry fields, error fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, lenient_int, num_truthy, strip_text

# Fixed values (must equal the reference): task kinds probed in this order.
RUN_TASK_KINDS = [
    "notebook_task",
    "spark_jar_task",
    "spark_python_task",
    "pipeline_task",
    "python_wheel_task",
    "spark_submit_task",
    "dbt_task",
    "sql_task",
    "run_job_task",
]

# Error categories, first match in this order wins.
ERROR_CATEGORIES = [
    "RESOURCE_DOES_NOT_EXIST",
    "UNAUTHENTICATED",
    "PERMISSION_DENIED",
    "INVALID_PARAMETER_VALUE",
    "INTERNAL_ERROR",
    "TIMEOUT",
    "CANCELLED",
    "NOT_FOUND",
]

# Error providers and their plain-substring triggers, in order.
ERROR_PROVIDERS = [
    ("GIT", ["GIT", "GITHUB"]),
    ("DLT", ["PIPELINE", "DELTA LIVE TABLES", "DLT"]),
    ("UNITY_CATALOG", ["SCHEMA", "CATALOG", "TABLE"]),
]

# Fixed value: characters of the short error field (the full text stays in
# ``output_error`` and ``state_message``).
SHORT_ERROR_CHARS = 240
# Fixed value: what a refused get-output call of a multi-task run says.
MULTI_TASK_REFUSAL = "multiple tasks is not supported"


def present_kinds(obj: Column, kinds: list[str] = RUN_TASK_KINDS, keys: bool = True) -> Column:
    """Names of the kind fields that a payload struct holds.

    They are read from its ``payload_keys``, which landed readers fill, so a
    kind with a null value counts; a payload without them (``keys`` False, or
    null) gives the kinds whose fields are not null.
    """
    filled = F.filter(
        F.array(*[F.when(obj.getField(k).isNotNull(), F.lit(k)) for k in kinds]),
        lambda x: x.isNotNull(),
    )
    return F.coalesce(obj.getField("payload_keys"), filled) if keys else filled


def raw_keys(raw: Column | str) -> Column:
    """Top-level keys of a JSON object held as text (null if not an object)."""
    return F.json_object_keys(col_of(raw))


def infer_task_type(keys: Column, task_raw: Column | None = None) -> Column:
    """Kind of a run/task payload: the first kind key present, with ``_task``.

    ``keys`` are the payload's own top-level keys. When the payload carries a
    non-empty ``task`` object, only that object's keys are searched (even if
    none of them is a kind).
    """
    cand = keys
    if task_raw is not None:
        # a lambda's variable: the payloads are parsed once, not again for every kind
        cand = F.element_at(F.transform(F.array(raw_keys(task_raw)), lambda inner: F.when(F.size(inner) > 0, inner).otherwise(keys)), 1)
    kinds = F.array(*[F.lit(k) for k in RUN_TASK_KINDS])
    return F.try_element_at(F.array_intersect(kinds, cand), F.lit(1))


def attempt_number(*candidates: Column) -> Column:
    """First candidate that parses as an integer (0 included)."""
    return F.coalesce(*[lenient_int(c) for c in candidates])


def original_attempt_run_id(*candidates: Column) -> Column:
    """First candidate that parses as an integer (0 included)."""
    return F.coalesce(*[lenient_int(c) for c in candidates])


def is_retry(attempts: list[Column], originals: list[Column], run_id: Column) -> Column:
    """True when any attempt candidate is > 0, or the original run id differs.

    The original id is the first *truthy* candidate (0 falls through here,
    unlike :func:`original_attempt_run_id`), compared with a truthy run id.
    """
    return is_retry_of([lenient_int(a) for a in attempts], [lenient_int(o) for o in originals], run_id)


def is_retry_of(attempt_ints: list[Column], original_ints: list[Column], run_id: Column) -> Column:
    """:func:`is_retry` over candidates already parsed to integers."""
    any_attempt = F.lit(False)
    for a in attempt_ints:
        any_attempt = any_attempt | F.coalesce(a > F.lit(0), F.lit(False))
    orig = F.coalesce(*[num_truthy(o) for o in original_ints])
    differs = F.coalesce((orig != run_id) & (run_id != F.lit(0)), F.lit(False))
    return any_attempt | differs


def clean_error(message: Column | str) -> Column:
    """Newlines to spaces, then Unicode-aware strip; null/'' stay null."""
    m = col_of(message)
    return F.when(m != F.lit(""), strip_text(F.replace(m, F.lit("\n"), F.lit(" "))))


def category_of_upper(up: Column) -> Column:
    """First category key contained in already cleaned, upper-cased text."""
    out = F.lit(None).cast("string")
    for key in reversed(ERROR_CATEGORIES):
        out = F.when(up.contains(key), F.lit(key)).otherwise(out)
    return out


def provider_of_upper(up: Column) -> Column:
    """First provider whose trigger substrings occur in upper-cased text."""
    out = F.lit(None).cast("string")
    for label, keys in reversed(ERROR_PROVIDERS):
        hit = F.lit(False)
        for k in keys:
            hit = hit | up.contains(k)
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def error_category(message: Column | str) -> Column:
    return category_of_upper(F.upper(clean_error(message)))


def error_provider(message: Column | str) -> Column:
    return provider_of_upper(F.upper(clean_error(message)))


def error_short(message: Column | str) -> Column:
    return F.substring(clean_error(message), 1, SHORT_ERROR_CHARS)


def failed_call_text(endpoint: str, run_id: Column, status: Column, body: Column) -> Column:
    """Message of a failed API call, as the landed HTTP status and body give it."""
    label = f"{endpoint} failed for run_id="
    return F.concat(
        F.lit(label), run_id.cast("string"), F.lit(": HTTP "), status.cast("string"),
        F.lit(" - "), F.coalesce(body, F.lit("")),
    )
