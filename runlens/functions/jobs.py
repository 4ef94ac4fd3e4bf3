"""Column rules for job definitions and the job-level summary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col_of, str_truthy

# Inventory task kinds in probing order (without ``_task``);
# a task with none of them is "other".
JOB_TASK_KINDS = [
    "notebook", "spark_python", "python_wheel", "spark_jar", "spark_submit",
    "pipeline", "sql", "dbt", "run_job", "condition", "for_each",
    "clean_rooms_notebook", "gen_ai_compute",
]
# Pivot vocabularies of the summary.
TASK_TYPES = JOB_TASK_KINDS + ["other"]
LANGUAGES = ["PYTHON", "SQL", "SCALA", "R"]
COMPUTE_TYPES = [
    "job_cluster", "interactive", "serverless", "none",
    "clean_rooms", "gen_ai_compute", "unknown",
]
# Task kinds without compute.
NO_COMPUTE_TYPES = ["condition", "for_each", "run_job"]
# Task kind -> language contribution; skipped kinds give none.
TASK_LANGUAGE = {
    "spark_python": "python",
    "python_wheel": "python",
    "sql": "sql",
    "spark_jar": "investigation_needed",
    "other": "investigation_needed",
}
SKIP_LANGUAGE_TYPES = [
    "spark_submit", "pipeline", "dbt", "run_job",
    "condition", "for_each", "clean_rooms_notebook", "gen_ai_compute",
]
INVESTIGATION_MARKER = "investigation_needed"
INVESTIGATION_TYPES = ["spark_jar", "other"]
MOSTLY_NUM, MOSTLY_DEN = 4, 5  # share >= 0.8, compared on integers

# Job-name checks, label and case-insensitive search pattern.
JOB_NAME_PATTERNS = [
    ("env:dev", r"\bdev\b"),
    ("env:prod", r"\bprod\b"),
    ("env:staging", r"\b(?:staging|stg)\b"),
    ("env:uat", r"\buat\b"),
    ("env:qa", r"\bqa\b"),
    ("temp", r"\b(?:temp|tmp|scratch)\b"),
    ("test", r"\btest(?:ing)?\b"),
    ("sandbox", r"\b(?:sandbox|demo|poc|prototype|experiment)\b"),
    ("copy", r"(?:\bcopy\s*(?:of)?\b|\bclone\b|\bold\b|\bbackup\b|\bbak\b|\([\d]+\)|_v\d+)"),
    ("unnamed", r"^(?:Untitled|New\s*Job|notebook_job)\s*\d*$"),
    ("personal", r"\bmy[_\-]"),
]

# Summary tag column -> accepted tag names (case-insensitive).
TAG_VARIANTS = {
    "application": ["application"],
    "cost_center": ["cost center", "cost-center"],
    "supporting_team": ["supporting team", "supporting_team", "team"],
    "domain": ["domain"],
}

# Fixed value: how a runtime version begins.
VERSION_RE = r"^(\d+)\.(\d+)"


def task_type(task: Column) -> Column:
    """Inventory kind of a task struct: first ``<kind>_task`` that is set."""
    out = F.lit("other")
    for k in reversed(JOB_TASK_KINDS):
        out = F.when(task.getField(f"{k}_task").isNotNull(), F.lit(k)).otherwise(out)
    return out


def cluster_type(task: Column, ttype: Column) -> Column:
    """Compute type of a task, checks in the reference's order."""
    serverless_kind = (
        task.getField("notebook_task").isNotNull()
        | task.getField("spark_python_task").isNotNull()
        | task.getField("sql_task").isNotNull()
    )
    return (
        F.when(ttype.isin(*NO_COMPUTE_TYPES), F.lit("none"))
        .when(str_truthy(task.getField("job_cluster_key")).isNotNull(), F.lit("job_cluster"))
        .when(str_truthy(task.getField("existing_cluster_id")).isNotNull(), F.lit("interactive"))
        .when(task.getField("new_cluster").isNotNull(), F.lit("job_cluster"))
        .when(str_truthy(task.getField("environment_key")).isNotNull(), F.lit("serverless"))
        .when(serverless_kind, F.lit("serverless"))
        .when(ttype == F.lit("clean_rooms_notebook"), F.lit("clean_rooms"))
        .when(ttype == F.lit("gen_ai_compute"), F.lit("gen_ai_compute"))
        .otherwise(F.lit("unknown"))
    )


def shared_cluster_version(job_clusters: Column, key: Column) -> Column:
    """Version of the job's shared cluster named ``key``; the last duplicate wins.

    Evaluated inside the row (the job's cluster list travels with its tasks),
    so this lookup needs no join and no shuffle.
    """
    hits = F.filter(job_clusters, lambda jc: jc.getField("job_cluster_key") == key)
    return F.try_element_at(hits, F.lit(-1)).getField("new_cluster").getField("spark_version")


def runtime_version(task: Column, shared_version: Column, existing_version: Column) -> Column:
    """Task cluster version, else shared job cluster version, else the
    looked-up version of an existing cluster (which may itself be null)."""
    return F.coalesce(
        str_truthy(task.getField("new_cluster").getField("spark_version")),
        F.when(str_truthy(task.getField("job_cluster_key")).isNotNull(), str_truthy(shared_version)),
        F.when(str_truthy(task.getField("existing_cluster_id")).isNotNull(), existing_version),
    )


def notebook_name(path: Column | str) -> Column:
    p = col_of(path)
    return F.when(p != F.lit(""), F.substring_index(p, "/", -1))


def tags_text(tags: Column | str) -> Column:
    """Tag map -> JSON text for tables; an empty or missing map gives null."""
    m = col_of(tags)
    return F.when(F.size(m) > 0, F.to_json(m))


# Tokens of a dict literal: a text with its prefix, a number or word, or any other character.
_QUOTED = r"""[uUrR]?(?:'(?:[^'\\]|\\[\s\S])*'|"(?:[^"\\]|\\[\s\S])*")"""
_TOKEN = r"(" + _QUOTED + r"|[-+.\w]+|\S)"
# Pieces of a text: an escape, or what lies between escapes.
_ESCAPE = r"\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|[\s\S])"
_PIECE = r"(" + _ESCAPE + r"|[^\\]+)"
# The one-letter escapes of a text literal; a backslash before any other character stays.
_LETTERS = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "a": "\x07", "v": "\x0b", "\\": "\\", "'": "'", '"': '"',
            "\n": ""}
# Stand for the quotes of a text until the tokens are joined; a text's own control characters are escaped by then.
_OPEN, _CLOSE = "\x02", "\x03"


def _character(hexadecimal: Column) -> Column:
    """The character of a code point in hexadecimal digits; the replacement character for half of a pair, and for
    numbers beyond Unicode."""
    padded = F.lpad(hexadecimal, 8, "0")
    whole = padded.rlike("(?i)^0000([0-9a-c]...|d[0-7]..|[ef]...)$|^00(0[1-9a-f]|10)....$")
    return F.decode(F.unhex(F.when(whole, padded).otherwise(F.lit("0000fffd"))), "UTF-32")


def _unescaped(piece: Column) -> Column:
    """A piece of a text literal as the characters it stands for."""
    kind = F.substring(piece, 2, 1)
    digits = F.when(kind.isin("x", "u", "U"), F.substring(piece, 3, 8)).when(
        kind.rlike("[0-7]"), F.conv(F.substring(piece, 2, 3), 8, 16))
    bare = ~F.startswith(piece, F.lit("\\"))
    out = F.when(bare, piece)
    for letter, character in _LETTERS.items():
        out = out.when(piece == F.lit("\\" + letter), F.lit(character))
    number = F.length(piece) > F.when(kind.rlike("[0-7]"), 1).otherwise(2)
    return out.when(digits.isNotNull() & number, _character(digits)).otherwise(piece)


def _json_token(token: Column) -> Column:
    """A token of a Python literal as JSON; a text's quotes as _OPEN and _CLOSE."""
    quote = F.regexp_extract(token, r"""^[uUrR]?(['"])""", 1)
    raw = F.lower(F.substring(token, 1, 1)) == F.lit("r")
    inner = F.regexp_replace(token, r"""^[uUrR]?['"]|['"]$""", "")
    pieces = F.transform(F.regexp_extract_all(inner, F.lit(_PIECE), F.lit(1)), _unescaped)
    text = F.when(raw, inner).otherwise(F.array_join(pieces, ""))
    # to_json escapes what JSON has to escape; its own brackets and quotes are cut off
    escaped = F.to_json(F.array(text))
    escaped = F.substr(escaped, F.lit(3), F.length(escaped) - 4)
    return (F.when(quote != "", F.concat(F.lit(_OPEN), escaped, F.lit(_CLOSE)))
            .when(token == "None", F.lit("null"))
            .when(token.isin("True", "False"), F.concat(F.lit(_OPEN), token, F.lit(_CLOSE)))
            .otherwise(token))


def literal_as_json(text: Column) -> Column:
    """The text of a Python dict literal as JSON text: read token by token, so
    that quotes, escapes and words inside texts mean what they mean there.
    Texts side by side are one text, a comma before a closing bracket is none.
    A boolean's text stays as Python writes it."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(1)), _json_token)
    joined = F.replace(F.array_join(tokens, " "), F.lit(f"{_CLOSE} {_OPEN}"), F.lit(""))
    return F.translate(F.regexp_replace(joined, r", (?=[}\]])", ""), _OPEN + _CLOSE, '""')


def parse_tags(text: Column | str) -> Column:
    """Tag text -> map; unparseable text gives an empty map.

    Reads the JSON we write as it is. Text that is not JSON with double quotes
    is read as the legacy Python literal (:func:`literal_as_json`).
    """
    t = col_of(text)
    strict = {"allowSingleQuotes": "false"}
    literal = literal_as_json(t)
    # from_json reads up to the closing bracket; what follows it makes the literal no dict
    literal = F.when(literal.endswith("}"), literal)
    parsed = F.coalesce(F.from_json(t, "map<string,string>", strict), F.from_json(literal, "map<string,string>"))
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def extract_tag(tags: Column, variants: list[str]) -> Column:
    """Value for the first variant name present (case-insensitive; when keys
    differ only in case the later entry wins). Empty value gives null."""
    entries = F.map_entries(tags)

    def named(name: str):
        return lambda e: F.lower(e.getField("key")) == F.lit(name.lower())

    picks = []
    for v in variants:
        hits = F.filter(entries, named(v))
        picks.append(F.try_element_at(hits, F.lit(-1)).getField("value"))
    return F.nullif(F.coalesce(*picks), F.lit(""))


def version_key(version: Column | str) -> Column:
    """(major, minor) of a runtime version text, null if it does not start so."""
    v = col_of(version)
    ok = v.rlike(VERSION_RE)
    return F.when(
        ok,
        F.struct(
            F.regexp_extract(v, VERSION_RE, 1).try_cast("bigint").alias("major"),
            F.regexp_extract(v, VERSION_RE, 2).try_cast("bigint").alias("minor"),
        ),
    )


def job_name_issues(name: Column | str) -> Column:
    """Labels of the name checks that match, joined with ', '; 'unnamed' for
    a null or empty name; null when clean."""
    n = col_of(name)
    labels = [F.when(n.rlike("(?iU)" + p), F.lit(label)) for label, p in JOB_NAME_PATTERNS]
    joined = F.nullif(F.concat_ws(", ", *labels), F.lit(""))
    return F.when(F.coalesce(n, F.lit("")) == F.lit(""), F.lit("unnamed")).otherwise(joined)


def job_name_flag(name: Column | str) -> Column:
    return F.when(job_name_issues(name).isNotNull(), F.lit("Y")).otherwise(F.lit("N"))


def task_language(ttype: Column, notebook_language: Column) -> Column:
    """Language contribution of one task (null = none)."""
    out = F.when(ttype.isin(*SKIP_LANGUAGE_TYPES), F.lit(None).cast("string")).when(
        ttype == F.lit("notebook"), F.lower(str_truthy(notebook_language))
    )
    for k, lang in TASK_LANGUAGE.items():
        out = out.when(ttype == F.lit(k), F.lit(lang))
    return out


def recency_flag(end_time: Column, as_of: Column, months: int = 6) -> Column:
    """'Y' when the end time is on or after ``as_of`` minus ``months`` calendar
    months (month-end clamped), else 'N' (null end gives 'N')."""
    threshold = as_of - F.make_ym_interval(F.lit(0), F.lit(months))
    return F.when(end_time >= threshold, F.lit("Y")).otherwise(F.lit("N"))


def vote_label(n_langs: Column, top_lang: Column, top_count: Column, total: Column,
               pair: Column, flagged: Column) -> Column:
    """Job language from per-language counts (marker excluded) and a flag.
    The label texts are fixed values."""
    base = (
        F.when(n_langs == 0, F.lit("no_language_tasks"))
        .when(n_langs == 1, top_lang)
        .when(top_count * MOSTLY_DEN >= total * MOSTLY_NUM, F.concat(F.lit("mostly_"), top_lang))
        .when(n_langs == 2, F.array_join(pair, "_and_"))
        .otherwise(F.lit("mixed"))
    )
    return F.when(flagged, F.concat(base, F.lit("_needs_investigation"))).otherwise(base)
