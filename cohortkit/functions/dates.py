"""Date parts, whole-year ages and fiscal quarters as Column builders."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortkit import vocab
from cohortkit.functions.coerce import col_


def date_literal(value: dt.date | dt.datetime | str) -> Column:
    """A DATE literal from a date or its yyyy-MM-dd text; anything else is a
    ``ValueError`` here, whatever ``spark.sql.ansi.enabled`` says."""
    if isinstance(value, dt.datetime):
        value = value.date()
    if not isinstance(value, dt.date):
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", str(value)):
            raise ValueError(f"not a yyyy-MM-dd date: {value!r}")
        value = dt.date.fromisoformat(str(value))
    return F.lit(value)


def weekday_name(d) -> Column:
    return F.date_format(col_(d), "EEEE")


def month_name(d) -> Column:
    return F.date_format(col_(d), "MMMM")


def year_of(d) -> Column:
    return F.year(col_(d))


def date_parts(name: str) -> dict[str, Column]:
    """``<name>_day``, ``<name>_month`` and ``<name>_year`` for one date column."""
    return {
        f"{name}_day": weekday_name(name),
        f"{name}_month": month_name(name),
        f"{name}_year": year_of(name),
    }


def _ymd(d: Column) -> Column:
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


# Ages are read off the dates' yyyy-MM-dd text; a year past 9999 has no such
# text (it prints with a sign and five digits), so its age is NULL.
LAST_YEAR_AS_TEXT = 9999


def completed_years(later, earlier) -> Column:
    """Whole years from ``earlier`` to ``later`` (INT).

    Dates are compared as yyyymmdd numbers, so a birthday counts on its
    calendar day; the result truncates toward zero, so less than a year
    before ``earlier`` is 0.
    """
    a, b = col_(later), col_(earlier)
    diff = _ymd(a) - _ymd(b)
    fits = (F.year(a) <= LAST_YEAR_AS_TEXT) & (F.year(b) <= LAST_YEAR_AS_TEXT)
    return F.when(fits, (diff / F.lit(10000)).cast("int"))


def fiscal_quarter(month_name_col) -> Column:
    """Quarter label from an English month name; other text is NULL."""
    m = col_(month_name_col)
    out = None
    for label, months in vocab.QUARTER_MONTHS:
        cond = m.isin(months)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out
