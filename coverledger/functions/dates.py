"""Month arithmetic on dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def month_start(c: Column) -> Column:
    """First day of the month, always a DATE."""
    return F.trunc(c.cast("date"), "MM")


def month_end(c: Column) -> Column:
    """Last day of the month, always a DATE."""
    return F.last_day(c.cast("date"))


def month_end_at_or_after(c: Column) -> Column:
    """First month end, taken at midnight, that is not before the moment.

    10:00 on the last day of a month already belongs to the next month end.
    """
    end = F.last_day(c.cast("date"))
    return F.when(end.cast("timestamp_ntz") >= c.cast("timestamp_ntz"), end).otherwise(
        F.last_day(F.add_months(end, 1))
    )


def next_month_end(c: Column) -> Column:
    return F.last_day(F.add_months(c, 1))


def year_range(c: Column, first_year: int, last_year: int) -> Column:
    """Whole-year filter written as a range, so the scan can prune on it."""
    return (c >= F.lit(dt.date(first_year, 1, 1))) & (c < F.lit(dt.date(last_year + 1, 1, 1)))
