"""Text to typed values, with a fallback where the text is malformed."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an unreadable date becomes, and the text of a whole number.
UNREADABLE_DATE = "7777-01-01"
WHOLE_NUMBER = "^[+-]?[0-9]+$"
FLOATING_POINT = r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(c: Column | str, dtype: str) -> Column:
    c = _col(c).cast("string")
    # A cast would accept ' 5 '; a whole number here has no blanks around it.
    return F.coalesce(F.when(c.rlike(WHOLE_NUMBER), c.try_cast(dtype)), F.lit(0).cast(dtype))


def clean_int(c: Column | str) -> Column:
    """Text to int; null, empty, malformed and out-of-range text give 0."""
    return _whole(c, "int")


def clean_long(c: Column | str) -> Column:
    """Text to bigint; null, empty, malformed and out-of-range text give 0."""
    return _whole(c, "bigint")


def clean_double(c: Column | str) -> Column:
    """Text to double; null, empty and malformed text give 0.

    Not a number and infinity count only as ``NaN`` and ``Infinity``; a cast
    would also take ``nan`` and ``inf``.
    """
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(F.when(text.rlike(FLOATING_POINT), text.try_cast("double")), F.lit(0.0))


def clean_string(c: Column | str) -> Column:
    """Null to the empty string."""
    return F.coalesce(_col(c), F.lit(""))


# Pattern letters of a date that are read here, and their place in (year, month, day).
_DATE_LETTERS = {"y": 0, "M": 1, "d": 2}


def clean_date(c: Column | str, fmt: str) -> Column:
    """Text in ``fmt`` (of y, M, d and separators) to a date; unreadable text gives 7777-01-01.

    Reading is lenient: one digit is enough for a month or day, what follows the
    date is ignored, and days and months beyond their range run on into the next
    ones, so the 32nd of January is the first of February.
    """
    fields, pattern = [], ""
    parts = re.findall(r"y+|M+|d+|[^yMd]+", fmt)
    for k, part in enumerate(parts):
        place = _DATE_LETTERS.get(part[0])
        if place is None:
            pattern += re.escape(part)
            continue
        fields.append(place)
        # Next to another field the width is fixed, else all digits belong to it.
        abuts = k + 1 < len(parts) and parts[k + 1][0] in _DATE_LETTERS
        pattern += rf"\s*([0-9]{{{len(part)}}})" if abuts else r"\s*([0-9]+)"
    if sorted(fields) != [0, 1, 2]:
        raise ValueError(f"{fmt!r} does not hold one year, month and day")
    text = _col(c).cast("string")
    found = [F.regexp_extract(text, "^" + pattern, fields.index(k) + 1).try_cast("int") for k in range(3)]
    year, month, day = found
    start = F.try_make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    # Beyond these bounds the year would leave the range of dates.
    sane = (year <= 9999) & (month <= 10_000) & (day <= 1_000_000)
    date = F.when(sane, F.date_add(F.add_months(start, month - 1), day - 1))
    return F.coalesce(date, F.lit(UNREADABLE_DATE).cast("date"))


def md5_hex(c: Column | str) -> Column:
    """MD5 of the UTF-8 text as 32 lower-case hex digits."""
    return F.md5(_col(c).cast("binary"))


def norm_name(c: Column | str) -> Column:
    """Organisation name without surrounding blanks, in upper case."""
    return F.upper(F.trim(_col(c)))
