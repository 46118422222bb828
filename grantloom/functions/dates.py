"""Date expressions. "Today" is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx

AsOf = dt.date | str | None


def as_of_date(as_of: AsOf) -> Column:
    """Literal date of the run; the current date only when the caller gives none."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def parse_day_first(c: Column) -> Column:
    """Day-first date text, also ISO with or without a time; anything else is null."""
    text = tx.blank_to_null(c)
    return F.coalesce(
        F.try_to_date(text, "d/M/yyyy"),
        F.try_to_date(text, "yyyy-MM-dd HH:mm:ss"),
        F.try_to_date(text, "yyyy-MM-dd"),
        F.try_to_date(text, "d/M/yyyy HH:mm:ss"),
    )


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def to_sql_date(c: Column) -> Column:
    """ISO text of day-first date text; blank or bad text is null."""
    return iso(parse_day_first(c))


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def month_boundaries(start: Column, end: Column) -> Column:
    """How many month starts lie between two dates (31 Jan to 1 Feb is 1)."""
    return (F.year(end) - F.year(start)) * F.lit(12) + (F.month(end) - F.month(start))


def first_of_previous_month(day: Column) -> Column:
    return F.add_months(F.trunc(day, "MM"), -1)
