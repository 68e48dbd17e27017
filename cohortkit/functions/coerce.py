"""Typed reads of text columns that do not depend on ``spark.sql.ansi.enabled``.

The source extracts are all-text. The cohort rules compare that text with
numeric literals, and the meaning of each comparison depends on the literal:

* a whole-number literal reads the text as an INT, truncating toward zero
  (``'50.7'`` is 50, ``'-0.5'`` is 0); text that is not a plain decimal
  number, or that overflows INT, is NULL;
* a decimal literal reads the text as a DOUBLE.

Both are written with ``try_cast`` so bad text gives NULL instead of an
error with ANSI mode on, and gives the same NULL with it off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = "Column | str"

# A plain decimal number: optional sign, digits with an optional fraction, or
# a bare fraction (a lone "." included); surrounding whitespace allowed. No
# exponent, no suffix.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d*)\s*$"
# Characters of a plain number that are not digits of its whole part.
NOT_DIGITS = " \t\n\r\f\u000b+-"
# The leading year-month-day of a text: three runs of digits joined by "-",
# each run optionally preceded by blanks or tabs; anything after is ignored.
DATE_HEAD = r"^[ \t]*(\d+-[ \t]*\d+-[ \t]*\d+)"
FIRST_DAY = "0001-01-01"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    """Text (or number) read as DOUBLE; unparseable text is NULL."""
    return col_(c).cast("string").try_cast("double")


def as_int(c) -> Column:
    """Text read as INT the way an implicit string-to-int cast reads it: the
    fraction is dropped (truncation toward zero), no digits before the point
    read as 0, and a whole part outside the INT range is NULL."""
    s = col_(c).cast("string")
    whole = F.substring_index(s, ".", 1)          # sign and digits, blanks around
    no_digits = F.length(F.translate(whole, NOT_DIGITS, "")) == 0
    return F.when(s.rlike(PLAIN_NUMBER),
                  F.when(no_digits, F.lit(0)).otherwise(whole.try_cast("int")))


class Numeric:
    """Both numeric readings of one text column, built once and reused by
    every comparison of a rule. ``for_(literal)`` gives the reading an
    implicit comparison with that literal would use: INT for a whole-number
    literal, DOUBLE for a decimal one."""

    def __init__(self, c):
        self._c, self._int, self._dbl = c, None, None

    def for_(self, literal) -> Column:
        if isinstance(literal, int):
            if self._int is None:
                self._int = as_int(self._c)
            return self._int
        if self._dbl is None:
            self._dbl = as_double(self._c)
        return self._dbl


def parse_date(c) -> Column:
    """A ``yyyy-MM-dd`` read the way the legacy (SimpleDateFormat) parser
    reads it: each field is a run of digits of any length (``2024-003-013``
    is 13 March), blanks or tabs before a field are skipped, anything after
    the day is ignored, and a field out of range (year 0, month 13, day 50,
    30 February) makes the whole value NULL.

    Well-formed text takes Spark's own string-to-date cast; only when that
    fails are the three digit runs read as numbers and assembled. Neither
    path depends on the session's time-parser policy or time zone.
    """
    head = F.regexp_extract(col_(c).cast("string"), DATE_HEAD, 1)
    fields = F.split(head, "-")
    zero = F.lit(0)
    assembled = F.try_make_timestamp_ntz(
        *[F.get(fields, i).try_cast("int") for i in range(3)], zero, zero, zero).cast("date")
    date = F.coalesce(head.try_cast("date"), assembled)
    # the legacy calendar has no year 0
    return F.when(date >= F.lit(FIRST_DAY).cast("date"), date)


def days_between(end, start) -> Column:
    return F.datediff(col_(end), col_(start))
