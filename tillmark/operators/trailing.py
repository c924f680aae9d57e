"""Trailing frames over a dense daily series.

Frames count rows, so they equal days only on a gap-free calendar. Each series
is one entity's days, which the length of the calendar bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tillmark.functions.money import percent


def trailing_sum(value: str, keys: Sequence[str], day: str, rows: int) -> Column:
    return F.sum(value).over(_frame(keys, day, rows))


def trailing_rows(keys: Sequence[str], day: str, rows: int) -> Column:
    """Rows actually in the frame: fewer at the start of the series."""
    return F.count("*").over(_frame(keys, day, rows))


def previous(value: str, keys: Sequence[str], day: str) -> Column:
    return F.lag(value).over(Window.partitionBy(*keys).orderBy(day))


def change_percent(current: Column, before: Column, places: int = 1) -> Column:
    """NULL when there is no previous value or it is 0."""
    return percent(current - before, before, places)


def _frame(keys: Sequence[str], day: str, rows: int):
    return Window.partitionBy(*keys).orderBy(day).rowsBetween(1 - rows, 0)
