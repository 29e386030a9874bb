"""Reporting periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions.cleansing import _col


def as_date(value: dt.date | dt.datetime | str) -> dt.date:
    """A reporting date given as a date, a timestamp or ``yyyy-MM-dd`` text."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value[:10])


def month_start(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(c), "MM")


def month_index(year: Column | str, month: Column | str) -> Column:
    """Months counted from year 0, so that months can be subtracted."""
    return _col(year) * 12 + _col(month)


def rolling_12_months(c: Column | str, as_of: dt.date | str) -> Column:
    """True for dates in the 12 full months before the month of ``as_of``.

    The bounds are literals, so the predicate reaches the file scan.
    """
    day = as_date(as_of)
    end = day.replace(day=1) - dt.timedelta(days=1)
    start = day.replace(year=day.year - 1, day=1)
    return _col(c).between(F.lit(start), F.lit(end))


def in_pass_year(c: Column | str, as_of: dt.date | str, back: int = 0) -> Column:
    """True for dates in the year of ``as_of``, or in the one ``back`` years before it.

    The bounds are literals, so the predicate reaches the file scan.
    """
    year = as_date(as_of).year - back
    return _col(c).between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))


def pass_years(as_of: dt.date | str) -> tuple[int, int, int]:
    """The current year and the two before it."""
    year = as_date(as_of).year
    return year, year - 1, year - 2
