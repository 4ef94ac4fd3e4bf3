"""Generic Column helpers: truthiness, lenient integers, time text, durations.

Every function here maps Column -> Column and stays inside Catalyst (no Python
UDF), so the expressions fuse into whole-stage codegen next to the scan.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes Unicode whitespace; Java needs (?U) for that.
_EDGE_SPACE = r"(?U)^\s+|\s+$"
# Shapes Python int() accepts for text: optional sign, digit groups joined by
# single underscores, surrounding whitespace.
_INT_TEXT = r"(?U)^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Python ``str.strip()`` (Unicode whitespace) on a string column."""
    return F.regexp_replace(col_of(c), _EDGE_SPACE, "")


def str_truthy(c: Column | str) -> Column:
    """String operand of a Python ``or`` chain: null and '' are falsy."""
    c = col_of(c)
    return F.when(c != F.lit(""), c)


def num_truthy(c: Column | str) -> Column:
    """Numeric operand of a Python ``or`` chain: null and 0 are falsy."""
    c = col_of(c)
    return F.when(c != F.lit(0), c)


def struct_truthy(c: Column | str, fields: list[str]) -> Column:
    """Struct operand of a Python ``or`` chain.

    A JSON ``{}`` reads as a non-null struct whose fields are all null; the
    dict it stood for was empty, hence falsy.
    """
    c = col_of(c)
    present = F.lit(False)
    for f in fields:
        present = present | c.getField(f).isNotNull()
    return F.when(present, c)


def first_truthy(*operands: Column) -> Column:
    """``a or b or c``: operands must already be guarded by a ``*_truthy``."""
    return F.coalesce(*operands)


def lenient_int(c: Column | str) -> Column:
    """Python ``int(value)`` with failures mapped to null (text input).

    Text is accepted only in the shapes ``int()`` accepts (sign, digits,
    underscore groups, outer whitespace); ``'1.9'`` is rejected, which Spark's
    own cast would truncate. JSON booleans read as text become 1 / 0.
    """
    c = col_of(c).cast("string")
    digits = F.regexp_replace(strip_text(c), "_", "")
    return (
        F.when(c.rlike(_INT_TEXT), digits.try_cast("bigint"))
        .when(c == F.lit("true"), F.lit(1).cast("bigint"))
        .when(c == F.lit("false"), F.lit(0).cast("bigint"))
    )


def iso_utc(ms: Column | str) -> Column:
    """Epoch milliseconds -> Python ``datetime.isoformat()`` text in UTC.

    Null and 0 give null (the reference tests truthiness). Python prints the
    fraction only when it is non-zero, and then with six digits. Requires the
    session time zone to be UTC.
    """
    ms = col_of(ms)
    ts = F.timestamp_millis(ms)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(ms != F.lit(0), F.when(F.pmod(ms, F.lit(1000)) == 0, whole).otherwise(frac))


def duration_ms(start_ms: Column | str, end_ms: Column | str) -> Column:
    """``end - start`` when both bounds are truthy (non-null, non-zero)."""
    s, e = col_of(start_ms), col_of(end_ms)
    return F.when((s != F.lit(0)) & (e != F.lit(0)), e - s)


def duration_seconds_1dp(start_ms: Column | str, end_ms: Column | str) -> Column:
    """Duration in seconds with one decimal, half-up on integer millis.

    ``((ms + 50) div 100) / 10``; the reference rounds binary floats, which
    differs only on exact 50 ms ties (documented deliberate difference).
    """
    d = duration_ms(start_ms, end_ms)
    return (F.floor((d + F.lit(50)) / F.lit(100)) / F.lit(10.0)).cast("double")


# Accepted time-text shapes (fixed values of the reference's parser):
#  1. ISO 8601 when the text has 'T', ends with 'Z' or contains '+'
#     (extended or basic form; fraction of any length, truncated to micros)
#  2. 'YYYY-MM-DD HH:MM:SS' (UTC)
#  3. 'YYYY-MM-DD' (start of day, UTC)
_ZONE = r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?"
_TIME = r"[0-9]{2}(:?[0-9]{2}(:?[0-9]{2})?)?([.,][0-9]+)?"
_ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([^0-9]" + _TIME + ")?" + _ZONE + "$"
_ISO_BASIC = r"^[0-9]{8}([^0-9]" + _TIME + ")?" + _ZONE + "$"
_PLAIN_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
_DATE_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def _iso_extended(s: Column) -> Column:
    """Normalise ISO text the way Python's ``fromisoformat`` reads it: a
    trailing 'Z' as +00:00, basic forms to extended form, any single non-digit
    between date and time as the separator (so '2025-09-24+02:00' is 02:00,
    not a zone), a fraction after hours or minutes as fractional seconds, and
    the fraction cut to microseconds."""
    t = F.regexp_replace(s, r"Z$", "+00:00")
    t = F.regexp_replace(t, r"^([0-9]{4})([0-9]{2})([0-9]{2})(?=[^0-9]|$)", "$1-$2-$3")
    t = F.regexp_replace(t, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})[^0-9](?=[0-9]{2})", "$1T")
    t = F.regexp_replace(t, r"T([0-9]{2})([0-9]{2})([0-9]{2})", "T$1:$2:$3")
    t = F.regexp_replace(t, r"T([0-9]{2})([0-9]{2})(?=[-+.,]|$)", "T$1:$2")
    t = F.regexp_replace(t, r"T([0-9]{2}):([0-9]{2})([0-9]{2})", "T$1:$2:$3")
    t = F.regexp_replace(t, r"T([0-9]{2})([0-9]{2}):([0-9]{2})", "T$1:$2:$3")
    # Spark's cast wants seconds before a zone or fraction: pad 'HH', 'HH:mm'
    t = F.regexp_replace(t, r"T([0-9]{2})(?=[-+.,]|$)", "T$1:00:00")
    t = F.regexp_replace(t, r"T([0-9]{2}):([0-9]{2})(?=[-+.,]|$)", "T$1:$2:00")
    t = F.regexp_replace(t, r",", ".")
    return F.regexp_replace(t, r"(\.[0-9]{6})[0-9]+", "$1")


def to_epoch_ms(text: Column | str) -> Column:
    """Time text -> epoch milliseconds (UTC when no zone); null if unparseable.

    The ISO branch is taken when the text contains 'T' or '+' or ends in 'Z';
    otherwise only the two plain shapes parse (a '-02:00' offset without 'T'
    therefore fails, as in the reference). Sub-millisecond input truncates.
    """
    s = strip_text(text)
    iso_branch = s.contains("T") | s.endswith("Z") | s.contains("+")
    iso_ts = _iso_extended(s).try_cast("timestamp")
    date_ts = F.try_to_timestamp(F.concat(s, F.lit(" 00:00:00")), F.lit("yyyy-M-d H:m:s"))
    plain_ts = F.try_to_timestamp(s, F.lit("yyyy-M-d H:m:s"))
    ts = (
        F.when(iso_branch, F.when(s.rlike(_ISO_SHAPE) | s.rlike(_ISO_BASIC), iso_ts))
        .when((F.length(s) == 10) & s.rlike(_DATE_SHAPE), date_ts)
        .when(s.rlike(_PLAIN_SHAPE), plain_ts)
    )
    return F.unix_millis(ts)


def to_epoch_ms_strict(value: str) -> int:
    """Driver-side form for window bounds (parameters, not data): the shapes of
    :func:`to_epoch_ms`, but text of no such shape raises ``ValueError``."""
    text = value.strip()
    if re.search("[T+]|Z$", text) and (re.match(_ISO_SHAPE, text) or re.match(_ISO_BASIC, text)):
        # a final 'Z' becomes an offset first, as in the column form: a date alone may bear one
        moment = datetime.fromisoformat(re.sub("Z$", "+00:00", text))
    elif re.match(_PLAIN_SHAPE, text) or (len(text) == 10 and re.match(_DATE_SHAPE, text)):
        moment = datetime(*map(int, re.findall("[0-9]+", text)))
    else:
        raise ValueError(f"{value!r} is not a time in any accepted shape")
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)
