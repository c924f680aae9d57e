"""Global positions and prefix sums without a one-task window.

``Window.orderBy`` with no partition sends every row to one task. Here the rows
are range-partitioned and sorted on a unique key, written once, and numbered
inside each range ("bucket"). What one bucket has to know about the buckets
before it comes from a summary with one row per bucket; that row count is at
most the number of shuffle partitions, so the summary is safe to order in one
task and to broadcast, however large the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.session import cut_lineage

BUCKET = "_bucket"
SLOT = "_slot"

# monotonically_increasing_id: partition in the high bits, row in the low 33.
_ROW_BITS = 33


def in_buckets(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in global order, each with its bucket and 0-based slot in it.

    Runs the plan below once. The order must be unique, both for a defined
    result and so that no run of equal keys overfills one range. The written
    copy is what keeps later passes on the same bounds: re-executing a range
    shuffle samples new ones.
    """
    placed = cut_lineage(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    )
    return placed.withColumns(
        {
            BUCKET: F.shiftright("_place", _ROW_BITS),
            SLOT: F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_place")


def before_bucket(column: str) -> Column:
    """Sum of a summary column over all earlier buckets."""
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def with_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Append the 1-based position in a unique global order."""
    placed = in_buckets(df, order)
    summary = (
        placed.groupBy(BUCKET)
        .agg(F.count("*").alias("_rows"))
        .select(BUCKET, before_bucket("_rows").alias("_offset"))
    )
    return (
        placed.join(F.broadcast(summary), BUCKET)
        .withColumn(name, F.col("_offset") + F.col(SLOT) + 1)
        .drop(BUCKET, SLOT, "_offset")
    )


def with_running_total(
    df: DataFrame, order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Append the sum of ``value`` up to and including each row."""
    placed = in_buckets(df, order)
    summary = (
        placed.groupBy(BUCKET)
        .agg(F.sum(value).alias("_total"))
        .select(BUCKET, before_bucket("_total").alias("_offset"))
    )
    inside = (
        Window.partitionBy(BUCKET).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.withColumn("_inside", F.sum(value).over(inside))
        .join(F.broadcast(summary), BUCKET)
        .withColumn(name, F.col("_offset") + F.col("_inside"))
        .drop(BUCKET, SLOT, "_inside", "_offset")
    )


def with_last_seen(
    df: DataFrame, order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Append the latest non-NULL ``value`` at or before each row."""
    placed = in_buckets(df, order)
    summary = placed.groupBy(BUCKET).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(SLOT))).alias("_last")
    )
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        BUCKET, F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    )
    inside = (
        Window.partitionBy(BUCKET).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
        .join(F.broadcast(carried), BUCKET)
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop(BUCKET, SLOT, "_inside", "_carried")
    )
