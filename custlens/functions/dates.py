"""Date and time helpers.

Driver parquet timestamps arrive as TIMESTAMP_NTZ, so every literal here is NTZ
too; mixing in a session-zoned TIMESTAMP would make results depend on the
session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the strict date shape accepted by `strptime('%Y-%m-%d')`
# (one- or two-digit month and day, nothing before or after).
YMD_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
# Fixed value: an integer written as text, surrounding blanks allowed.
INT_TEXT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: str | dt.date | dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (the `as_of` of every time-relative rule)."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def safe_timestamp(c: ColumnOrName) -> Column:
    """parse to TIMESTAMP_NTZ, NULL when malformed (errors='coerce')."""
    return _col(c).try_cast("timestamp_ntz")


def parse_timestamp_any(c: ColumnOrName, formats: list[str]) -> Column:
    """try several timestamp formats in order, first success wins."""
    col = _col(c)
    tries = [F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]
    tries.append(safe_timestamp(col))
    return F.coalesce(*tries)


def fill_missing_shipment(ship: ColumnOrName, invoice: ColumnOrName, days: int = 5) -> Column:
    """a missing shipment date is the invoice date plus ``days``."""
    return F.coalesce(_col(ship), _col(invoice) + F.make_dt_interval(F.lit(days)))


def _seconds_of_day(ts: Column) -> Column:
    """Seconds since midnight of a wall-clock timestamp, with the fraction."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)


def elapsed_days(ts: ColumnOrName, as_of: Column) -> Column:
    """whole days from ``ts`` to ``as_of``, floored (Python timedelta.days).

    Computed on the wall clock — calendar-day difference plus the difference
    of the times of day — so it never depends on the session time zone
    (``timestampdiff`` converts TIMESTAMP_NTZ to a zoned timestamp, which
    loses or gains an hour across a daylight-saving change). Floored, since
    ``timestampdiff(DAY)`` would truncate toward zero.
    """
    t = _col(ts)
    seconds = F.datediff(F.to_date(as_of), F.to_date(t)) * F.lit(86_400) + (_seconds_of_day(as_of) - _seconds_of_day(t))
    return F.floor(seconds / F.lit(86_400)).cast("bigint")


def month_start(c: ColumnOrName) -> Column:
    """F8: first day of the month, as DATE."""
    return F.trunc(_col(c), "MM")


def month_index(later: ColumnOrName, first: ColumnOrName) -> Column:
    """calendar-month distance plus one (cohort index)."""
    a, b = _col(later), _col(first)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b)) + 1).cast("int")


def format_ymd(c: ColumnOrName) -> Column:
    """format as ``YYYY-MM-DD`` (through DATE, so no time zone is
    involved, unlike ``date_format`` on a TIMESTAMP_NTZ)."""
    return F.to_date(_col(c)).cast("string")


def months_before(as_of: Column, months: int) -> Column:
    """calendar-month offset with end-of-month clipping (31 May − 3 = 29 Feb)."""
    return as_of - F.make_ym_interval(F.lit(0), F.lit(months))


def _days_as_int(n: ColumnOrName) -> Column:
    """The day count of F5: numbers truncate (Python ``int``), text must be an
    integer literal, anything else is NULL."""
    col = _col(n)
    as_text = col.cast("string")
    return (
        F.when(as_text.rlike(INT_TEXT_PATTERN), F.trim(as_text).try_cast("int"))
        .otherwise(as_text.try_cast("double").cast("int"))
    )


def add_days_checked(date_value: ColumnOrName, days: ColumnOrName, date_is_text: bool = True) -> Column:
    """date plus N days; NULL ("Invalid") for a bad date or a bad N.

    Text dates must match ``YYYY-M-D`` exactly (strptime semantics); the cast is
    ``try_cast`` so impossible dates such as 2001-13-45 are NULL too.
    """
    d = _col(date_value)
    if date_is_text:
        parsed = F.when(d.rlike(YMD_PATTERN), d.try_cast("date"))
    else:
        parsed = F.to_date(d)
    n = _days_as_int(days)
    return F.when(parsed.isNotNull() & n.isNotNull(), F.date_add(parsed, n))


def operational_day(ts: ColumnOrName, start_hour: int = 12, start_minute: int = 31) -> Column:
    """The business day runs from 12:31 to 12:30:59 the next calendar day,
    labelled by the calendar day it starts on."""
    shift = F.make_dt_interval(F.lit(0), F.lit(start_hour), F.lit(start_minute))
    return F.to_date(_col(ts) - shift)


def hour_label(ts: ColumnOrName) -> Column:
    """``HH:00`` of the hour the event falls in (wall clock, no time zone)."""
    return F.format_string("%02d:00", F.hour(_col(ts)))
