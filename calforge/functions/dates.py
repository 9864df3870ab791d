"""Date / start-time parsing with the leniency of Python's ``strptime``.

``strptime('%Y-%m-%d')`` wants exactly four year digits but takes one- or two-digit
months and days, and a day written as blank + digit; ``' '`` in a format matches any
run of whitespace; the whole string must be consumed. Spark's ``to_date`` patterns
are either stricter or laxer than that, so a regex guard decides *shape* and
``try_*`` constructors decide *validity* (Feb 30 -> NULL). Year 0 is legal in Spark
but not in Python, so it is excluded explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from calforge.functions.text import WS

YEAR = r"([0-9]{4})"
MONTH = r"(1[0-2]|0[1-9]|[1-9])"
DAY = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
HOUR = r"(2[0-3]|[01][0-9]|[0-9])"
MINUTE = r"([0-5][0-9]|[0-9])"

DATE_RE = rf"\A{YEAR}-{MONTH}-{DAY}\z"
START_RE = rf"\A{YEAR}-{MONTH}-{DAY}{WS}+{HOUR}:{MINUTE}\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _part(c: Column, pattern: str, idx: int) -> Column:
    return F.trim(F.regexp_extract(c, pattern, idx)).try_cast("int")


def parse_date(col) -> Column:
    """DATE for a valid ``YYYY-M-D`` string, else NULL (Python ``%Y-%m-%d`` rules).
    One regex decides the shape; the lenient ``y-M-d`` parser then only has to
    decide validity (it never sees a 2- or 5-digit year)."""
    c = _c(col)
    ok = c.rlike(DATE_RE) & ~c.startswith("0000")
    return F.when(ok, F.try_to_date(F.replace(c, F.lit(" "), F.lit("")), "y-M-d"))


def parse_date_sql(expr: str) -> str:
    return (f"CASE WHEN regexp_full_match({expr}, '{DATE_RE}') "
            f"AND regexp_extract({expr}, '{DATE_RE}', 1) <> '0000' "
            f"THEN try_strptime(replace({expr}, ' ', ''), '%Y-%m-%d')::DATE END")


def parse_start(date_col, time_col) -> Column:
    """TIMESTAMP_NTZ (local wall clock) of ``date + ' ' + time`` parsed as
    ``%Y-%m-%d %H:%M``, else NULL. No zone conversion ever happens. The string is
    matched once and rewritten to 'Y,M,D,H,M' (one split) instead of running one
    regex per field."""
    s = F.concat_ws(" ", _c(date_col), _c(time_col))
    ok = s.rlike(START_RE) & ~s.startswith("0000")
    parts = F.split(F.regexp_replace(s, START_RE, "$1,$2,$3,$4,$5"), ",")
    p = [F.trim(F.get(parts, i)).try_cast("int") for i in range(5)]
    return F.when(ok, F.try_make_timestamp_ntz(p[0], p[1], p[2], p[3], p[4], F.lit(0)))


def parse_start_sql(date_expr: str, time_expr: str) -> str:
    s = f"({date_expr} || ' ' || {time_expr})"
    parts = [f"TRY_CAST(trim(regexp_extract({s}, '{START_RE}', {i})) AS INTEGER)" for i in range(1, 6)]
    text = (f"printf('%04d-%02d-%02d %02d:%02d', {parts[0]}, {parts[1]}, {parts[2]}, {parts[3]}, {parts[4]})")
    return (f"CASE WHEN regexp_full_match({s}, '{START_RE}') "
            f"AND regexp_extract({s}, '{START_RE}', 1) <> '0000' "
            f"THEN try_strptime({text}, '%Y-%m-%d %H:%M') END")


def _fields(ts: Column):
    # field extraction on TIMESTAMP_NTZ reads the wall clock; date_format would first
    # convert to a session-zone timestamp and move times in a DST gap
    return (F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts).cast("int"))


def dtstart_text(ts_col) -> Column:
    """``yyyyMMddTHHmmss`` of the wall clock, in any session time zone."""
    ts = _c(ts_col)
    return F.when(ts.isNotNull(), F.format_string("%04d%02d%02dT%02d%02d%02d", *_fields(ts)))


def wall_clock_text(ts_col) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the wall clock, in any session time zone."""
    ts = _c(ts_col)
    return F.when(ts.isNotNull(), F.format_string("%04d-%02d-%02d %02d:%02d:%02d", *_fields(ts)))


def dtstart_text_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y%m%dT%H%M%S')"
