"""Date and time scalar functions (Column -> Column).

All of them are built-in Spark expressions, so they stay inside
whole-stage codegen.  ``as_of`` is always an explicit parameter: no
function here reads the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col


def fiscal_year_start(d) -> Column:
    """Calendar year in which the fiscal year (starting 1 April) of ``d`` began."""
    return F.year(F.add_months(F.to_date(as_col(d)), -3))


def fiscal_session(d) -> Column:
    """Fiscal session text ``YYYY-YYYY`` for a date; the year starts 1 April.

    2020-03-31 -> ``2019-2020``; 2020-04-01 -> ``2020-2021``; null -> null.
    """
    y = fiscal_year_start(d)
    return F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string"))


def fiscal_session_my(month, year) -> Column:
    """Fiscal session from integer month and year columns."""
    m, y = as_col(month).cast("int"), as_col(year).cast("int")
    start = F.when(m <= 3, y - 1).otherwise(y)
    return F.concat(start.cast("string"), F.lit("-"), (start + 1).cast("string"))


def serial_month(month, year) -> Column:
    """Serial month id ``(year - 1989) * 12 + month - 2``."""
    return (as_col(year).cast("int") - 1989) * 12 + as_col(month).cast("int") - 2


def month_label(d) -> Column:
    """Upper-case ``MON-YYYY`` label, e.g. ``JAN-1998``."""
    return F.upper(F.date_format(as_col(d), "MMM-yyyy"))


def month_label_my(month, year) -> Column:
    """``MON-YYYY`` label from integer month and year."""
    d = F.make_date(as_col(year).cast("int"), as_col(month).cast("int"), F.lit(1))
    return month_label(d)


def parse_month_label(label) -> Column:
    """Inverse of :func:`month_label`; parsing is case-insensitive."""
    return F.to_date(F.initcap(as_col(label)), "MMM-yyyy")


def month_year(d) -> Column:
    """``Mon-YYYY`` label, e.g. ``Jan-1998``."""
    return F.date_format(as_col(d), "MMM-yyyy")


def month_name(d) -> Column:
    """Full month name, e.g. ``January``."""
    return F.date_format(as_col(d), "MMMM")


def expand_year(label, pivot: int | None = None) -> Column:
    """Expand a two-digit trailing year of ``MON-YY`` text.

    ``pivot=None`` always prefixes ``20`` (the form the marts use);
    with a pivot, years below it get ``20`` and the rest ``19``.
    """
    c = as_col(label)
    n = F.length(c)
    left = c.substr(F.lit(1), n - 2)
    yy = c.substr(n - 1, F.lit(2))
    if pivot is None:
        century = F.lit("20")
    else:
        century = F.when(yy.cast("int") < pivot, F.lit("20")).otherwise(F.lit("19"))
    return F.concat(left, century, yy)


def normalize_date_text(text) -> Column:
    """``dd-mm-yyyy...`` text -> ``yyyy-mm-dd 00:00:00``; other text unchanged.

    A dash in the first four characters marks the day-first form.
    """
    c = as_col(text)
    day_first = F.instr(F.substring(c, 1, 4), "-") > 0
    rebuilt = F.concat(F.substring(c, 7, 4), F.lit("-"), F.substring(c, 4, 2),
                       F.lit("-"), F.substring(c, 1, 2), F.lit(" 00:00:00"))
    return F.when(day_first, rebuilt).otherwise(c)


def parse_date(text, formats=("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd-MM-yyyy",
                              "dd/MM/yyyy")) -> Column:
    """Parse text with the first format that fits; bad text -> null."""
    c = as_col(text)
    # wall-clock result (TIMESTAMP_NTZ): the same value whatever the session
    # time zone is
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def year_month(ts) -> tuple[Column, Column]:
    """(year, month) of a timestamp/date column."""
    c = as_col(ts)
    return F.year(c), F.month(c)


def year_month_from_yyyymm(v) -> tuple[Column, Column]:
    """(year, month) from a ``yyyymm`` integer."""
    c = as_col(v).cast("int")
    return (c / 100).cast("int"), F.pmod(c, F.lit(100))


def month_start(d) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(F.to_date(as_col(d)), "month")


def days_used(start, end) -> Column:
    """Whole days from ``start`` to ``end`` floored at 0."""
    return F.greatest(F.datediff(F.to_date(as_col(end)), F.to_date(as_col(start))),
                      F.lit(0))


def months_old(d, as_of) -> Column:
    """Months between ``d`` and the run date (Spark ``months_between`` rule)."""
    return F.months_between(F.to_date(F.lit(_as_date(as_of))), F.to_date(as_col(d)))


def run_parts(as_of) -> tuple[Column, Column, Column]:
    """Zero-padded run date parts (year, month, day) as text literals."""
    d = _as_date(as_of)
    return F.lit(f"{d:%Y}"), F.lit(f"{d:%m}"), F.lit(f"{d:%d}")


def elapsed_seconds(struct_col, start="start_time", end="end_time") -> Column:
    """Stage seconds from an epoch struct ``{start_time, end_time}``."""
    c = as_col(struct_col)
    return c.getField(end) - c.getField(start)


def load_ts_text(as_of, offset_minutes: int = 330) -> Column:
    """Load-audit time at UTC+5:30 (default) as ``yyyy-MM-dd HH:mm:ss`` text."""
    t = _as_datetime(as_of) + _dt.timedelta(minutes=offset_minutes)
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S"))


def _as_date(v) -> _dt.date:
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, _dt.date):
        return v
    return _dt.date.fromisoformat(str(v)[:10])


def _as_datetime(v) -> _dt.datetime:
    if isinstance(v, _dt.datetime):
        return v
    if isinstance(v, _dt.date):
        return _dt.datetime(v.year, v.month, v.day)
    return _dt.datetime.fromisoformat(str(v))
