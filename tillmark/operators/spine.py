"""Gap-free calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_bounds(df: DataFrame, day: str) -> tuple[Column, Column]:
    """First and last date of a table as scalar subqueries; NULL when it is empty."""
    bounds = df.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi")).alias("b")).scalar()
    return bounds["lo"], bounds["hi"]


def calendar_spine(
    entities: DataFrame, keys: Sequence[str], first: Column, last: Column, day: str
) -> DataFrame:
    """One row per distinct entity and day from ``first`` to ``last``, both included."""
    days = F.sequence(first, last, F.expr("INTERVAL 1 DAY"))
    return entities.select(*keys).distinct().withColumn(day, F.explode(days))
