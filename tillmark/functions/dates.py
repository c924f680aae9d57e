"""Calendar expressions on DATE columns."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: str | datetime.date | Column | None) -> Column:
    """The reporting date; the current date when none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def month_start(day: Column) -> Column:
    # trunc keeps DATE; date_trunc would give a TIMESTAMP tied to a time zone.
    return F.trunc(day, "MM")


def month_number(first: Column, later: Column) -> Column:
    """Whole calendar months from ``first`` to ``later``."""
    years = F.year(later) - F.year(first)
    return (years * 12 + F.month(later) - F.month(first)).cast("bigint")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def from_iso(text: Column) -> Column:
    return F.to_date(text, "yyyy-MM-dd")


def date_in_range(first: Column, last: Column, draw: Column) -> Column:
    """A day from ``first`` to ``last``, both included; the span is at least one day."""
    span = F.greatest(days_between(first, last), F.lit(1).cast("bigint"))
    return F.date_add(first, (draw % (span + 1)).cast("int"))
