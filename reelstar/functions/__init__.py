"""Column-level functions: parsing, typed projection, derived measures.

All are built-in Spark expressions (JVM side, whole-stage codegen); no UDFs.
Parsing uses the ``try_`` forms, so malformed input becomes NULL under ANSI
mode instead of failing the job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
# Event time as sent by the API: milliseconds and a literal Z.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# Length of a time with a year of four digits, and where its marks and the digits of its fraction stand.
EVENT_TIME_LENGTH = 24
EVENT_TIME_FRACTION = (21, 22, 23)
EVENT_TIME_MARKS = ((5, "-"), (8, "-"), (11, "T"), (14, ":"), (17, ":"), (20, "."), (24, "Z"))
# Channel detection on the lower-cased title; first match wins.
CHANNEL_RULES = (("facebook", "Facebook"), ("youtube", "YouTube"))
CHANNEL_DEFAULT = "Other"
# Calendar attribute formats (English names).
DAY_NAME_FORMAT = "E"
MONTH_NAME_FORMAT = "MMM"
LAST_WEEKDAY = 4  # Monday = 0 ... Friday = 4


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc(t: dt.datetime) -> dt.datetime:
    """The time in UTC, without a zone; one without a zone is taken as UTC."""
    return t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t


def parse_event_time(c: str | Column) -> Column:
    """Event time by the API pattern; anything else (no fraction, 6 digits,
    no Z, junk) is NULL.

    Where all marks stand in their places the cast reads the same wall clock in a fraction of
    the time (a zone it would take too can't stand there); the pattern decides on whatever is left.
    """
    c = as_col(c)
    usual = F.length(c) == EVENT_TIME_LENGTH
    for at, mark in EVENT_TIME_MARKS:
        usual = usual & (F.substring(c, at, 1) == mark)
    for at in EVENT_TIME_FRACTION:
        usual = usual & F.substring(c, at, 1).between("0", "9")
    fast = F.when(usual, F.substring(c, 1, EVENT_TIME_LENGTH - 1).try_cast("timestamp"))
    return F.coalesce(fast, F.try_to_timestamp(c, F.lit(EVENT_TIME_PATTERN)))


def typed_select(df: DataFrame, spec: Iterable[tuple[str, str, str | None]]) -> DataFrame:
    """Rename and cast by a spec of ``(source, target, type)``.

    ``type`` None keeps the column as is; the special type ``event_time``
    applies :func:`parse_event_time`.
    """
    cols = []
    for source, target, dtype in spec:
        c = F.col(source)
        if dtype == "event_time":
            c = parse_event_time(c)
        elif dtype is not None:
            c = c.try_cast(dtype)
        cols.append(c.alias(target))
    return df.select(*cols)


def channel_of(title: str | Column) -> Column:
    lowered = F.lower(as_col(title))
    expr = None
    for needle, label in CHANNEL_RULES:
        cond = lowered.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(CHANNEL_DEFAULT)


def watch_time(duration: str | Column, percent_viewed: str | Column) -> Column:
    """Seconds watched; percent on a 0-100 scale, same operation order as
    the reference (duration * percent / 100)."""
    return as_col(duration) * as_col(percent_viewed) / 100


def date_attributes(d: str | Column = "date") -> list[Column]:
    """Calendar attributes of ``dim_dates`` in table order (after ``date``)."""
    d = as_col(d)
    dow = F.weekday(d)
    return [
        F.month(d).alias("month_num"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, DAY_NAME_FORMAT).alias("day_of_week_name"),
        dow.alias("day_of_week"),
        (dow <= LAST_WEEKDAY).alias("is_weekday"),
        F.year(d).alias("year"),
        F.date_format(d, MONTH_NAME_FORMAT).alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
    ]
