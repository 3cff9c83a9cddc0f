"""ISO-week arithmetic as column expressions.

Weeks travel as ``YYYY-Www`` strings; ``week_number`` turns them into an integer
so that window frames can count calendar weeks.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WEEK_PATTERN = r"^\d{4}-W\d{2}$"
_LOOSE_WEEK = r"^\d{4}-W\d{1,2}$"
_LOOSE_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_FIRST_MONDAY = "1970-01-05"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day(c) -> Column:
    """First ten characters as a calendar date; NULL when they are not one."""
    head = F.substring(_col(c), 1, 10)
    return F.when(head.rlike(_LOOSE_DATE), F.try_to_date(head, "yyyy-M-d"))


def week_of_date(d) -> Column:
    """``YYYY-Www`` of a date column, with the ISO year."""
    d = _col(d)
    year = F.lpad(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), 4, "0")
    week = F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    return F.concat(year, F.lit("-W"), week)


def iso_week(c) -> Column:
    """``YYYY-Www`` of a date string; the empty string when it cannot be read."""
    day = parse_day(c)
    return F.when(day.isNull(), F.lit("")).otherwise(week_of_date(day))


def valid_week(c) -> Column:
    return _col(c).rlike(WEEK_PATTERN)


def parse_week(c) -> Column:
    """Monday of an ISO week string; NULL for malformed or impossible weeks."""
    c = _col(c)
    year = F.substring(c, 1, 4).try_cast("int")
    week = F.substring(c, 7, 2).try_cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_add(F.trunc(jan4, "week"), (week - 1) * 7)
    return F.when(c.rlike(_LOOSE_WEEK) & (year >= 1) & (F.weekofyear(monday) == week), monday)


def week_offset(c, weeks) -> Column:
    """The week ``weeks`` later; the empty string for malformed input."""
    shift = F.lit(weeks) if isinstance(weeks, int) else weeks
    moved = F.date_add(parse_week(c), shift * 7)
    return F.when(moved.isNull(), F.lit("")).otherwise(week_of_date(moved))


def week_number(c) -> Column:
    """Whole weeks between Monday 1970-01-05 and the given week."""
    days = F.datediff(parse_week(c), F.lit(_FIRST_MONDAY).cast("date"))
    return F.floor(days / 7).cast("int")


def weeks_between(later, earlier) -> Column:
    return F.floor(F.datediff(parse_week(later), parse_week(earlier)) / 7).cast("int")


def epoch_to_date(seconds) -> Column:
    """``YYYY-MM-DD`` in UTC, whatever the session time zone."""
    days = F.floor(_col(seconds) / 86400).cast("int")
    return F.date_format(F.date_from_unix_date(days), "yyyy-MM-dd")


def date_to_epoch(day) -> Column:
    """Seconds since the epoch at UTC midnight of a date string."""
    return F.unix_date(parse_day(day)).cast("long") * 86400
