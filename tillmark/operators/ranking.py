"""Rank, tiles and share of the total over a whole table, distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.money import percent
from tillmark.operators.ordering import (
    BUCKET,
    SLOT,
    before_bucket,
    in_buckets,
    with_running_total,
)
from tillmark.operators.selection import cuts_at, until


def with_ranks(
    df: DataFrame,
    value: str,
    tie_break: Sequence[str],
    descending: bool = True,
    total_of: str | None = None,
) -> DataFrame:
    """Append ``row_number``, ``rank``, ``rows`` (and ``total``) over the whole table.

    ``row_number`` follows ``value`` then ``tie_break`` (unique together);
    ``rank`` has gaps after ties. NULL values come first when descending. A
    value shared by very many rows is spread over several buckets by the tie
    break, and its rank is carried from the bucket where it starts.
    """
    ordering = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    placed = in_buckets(df, [ordering, *[F.col(name).asc() for name in tie_break]])
    local = placed.withColumn(
        "_local_rank", F.rank().over(Window.partitionBy(BUCKET).orderBy(ordering))
    )
    totals = [F.sum(total_of).alias("_sum")] if total_of else []
    # The summary comes from the written rows by sums per task: only the ranks inside the buckets
    # shuffle the rows themselves.
    ends = placed.groupBy(BUCKET).agg(
        F.count("*").alias("_rows"),
        F.min_by(value, SLOT).alias("_first"),
        F.max_by(value, SLOT).alias("_last"),
        *totals,
    )
    last = ends.select(F.col(BUCKET).alias("_in"), F.col("_last").alias("_end"))
    runs = (
        placed.select(BUCKET, SLOT, F.col(value).alias("_own"))
        .join(
            F.broadcast(last),
            (F.col(BUCKET) == F.col("_in")) & F.col("_own").eqNullSafe(F.col("_end")),
        )
        .groupBy(BUCKET)
        .agg((F.min(SLOT) + 1).alias("_last_rank"))
    )
    both = ends.unionByName(runs, allowMissingColumns=True)
    summary = both.groupBy(BUCKET).agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in both.columns if name != BUCKET]
    )

    by_bucket = Window.orderBy(BUCKET)
    earlier = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    continues = (F.lag(F.lit(True)).over(by_bucket).isNotNull()) & F.col("_first").eqNullSafe(
        F.lag("_last").over(by_bucket)
    )
    carried = (
        summary.withColumns({"_offset": before_bucket("_rows"), "_continues": continues})
        # Where the bucket's last run of equal values starts, unless in an earlier bucket.
        .withColumn(
            "_run_start",
            F.when(
                ~(F.col("_continues") & (F.col("_last_rank") == 1)),
                F.col("_offset") + F.col("_last_rank"),
            ),
        )
        .select(
            BUCKET,
            "_offset",
            F.when(
                F.col("_continues"), F.last("_run_start", ignorenulls=True).over(earlier)
            ).alias("_carried_rank"),
            F.sum("_rows").over(whole).alias("rows"),
            *([F.sum("_sum").over(whole).alias("total")] if total_of else []),
        )
    )
    return (
        local.join(F.broadcast(carried), BUCKET)
        .withColumns(
            {
                "row_number": F.col("_offset") + F.col(SLOT) + 1,
                "rank": F.when(
                    (F.col("_local_rank") == 1) & F.col("_carried_rank").isNotNull(),
                    F.col("_carried_rank"),
                ).otherwise(F.col("_offset") + F.col("_local_rank")),
            }
        )
        .drop(BUCKET, SLOT, "_local_rank", "_offset", "_carried_rank")
    )


def ranks_of_values(df: DataFrame, value: str, descending: bool = True) -> DataFrame:
    """Every distinct ``value`` once, with ``rank`` (with gaps after ties).

    Rows are counted per value in the tasks that read them; only the distinct values are ordered,
    so a value shared by very many rows is one line per task.
    """
    ordering = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    counted = df.groupBy(value).agg(F.count("*").alias("_count"))
    reached = with_running_total(counted, [ordering], "_count", "_reached")
    return reached.select(value, (F.col("_reached") - F.col("_count") + 1).alias("rank"))


def tile_ends(rows: int, tiles: int) -> list[int]:
    """The row numbers at which tiles end."""
    size, larger = divmod(rows, tiles)
    return [tile * size + min(tile, larger) for tile in range(1, tiles + 1)]


def _check_exact(df: DataFrame, value: str) -> None:
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        raise TypeError(f"cast {value} to DECIMAL first")


def _with_rank(df: DataFrame, ranks: DataFrame, value: str) -> DataFrame:
    own = ranks.withColumnRenamed(value, "_value")
    return df.join(own, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def spend_tiers(
    df: DataFrame,
    value: str,
    tie_break: Sequence[str],
    tiers: int = 4,
    tier_name: str = "spend_quartile",
    rank_name: str = "spend_rank",
    share_name: str = "pct_of_total_revenue",
    share_places: int = 2,
) -> DataFrame:
    """Append the tier (1 = highest), the rank and the percentage of the grand total.

    Equal values that straddle a tier boundary are split by ``tie_break``
    ascending. ``value`` must be DECIMAL or integral, so that shares are exact.
    Boundaries are selected by histograms and ranks belong to values, so the rows themselves are
    neither ordered nor written; they meet the ranks in one join. ``df`` is read several times.
    """
    _check_exact(df, value)
    cuts = cuts_at(df, value, tie_break, lambda rows: tile_ends(rows, tiers)[:-1])
    tier = F.lit(1)
    for cut in cuts.cuts:
        tier = tier + F.when(until(cut, value, tie_break), 0).otherwise(1)
    ranked = _with_rank(df, ranks_of_values(df, value), value)
    return ranked.select(
        *[F.col(name) for name in df.columns],
        tier.cast("bigint").alias(tier_name),
        F.col("rank").alias(rank_name),
        percent(F.col(value), _total_literal(df, value, cuts.total), share_places).alias(share_name),
    )


def one_tier(
    df: DataFrame,
    value: str,
    tie_break: Sequence[str],
    tier: int = 1,
    tiers: int = 4,
    rank_name: str = "spend_rank",
    share_name: str = "pct_of_total_revenue",
    share_places: int = 2,
) -> DataFrame:
    """The rows of one tier of ``spend_tiers``, with rank and share among all rows.

    Only the values inside the tier are put in order, for their ranks.
    """
    if not 1 <= tier <= tiers:
        raise ValueError(f"no tier {tier} of {tiers}")
    _check_exact(df, value)
    cuts = cuts_at(df, value, tie_break, lambda rows: [0, *tile_ends(rows, tiers)][tier - 1 : tier + 1])
    by_position = {cut.position: cut for cut in cuts.cuts}
    start, end = [0, *tile_ends(cuts.rows, tiers)][tier - 1 : tier + 1]
    inside = F.lit(start < end)
    if end in by_position:
        inside = inside & until(by_position[end], value, tie_break)
    if start in by_position:
        inside = inside & ~until(by_position[start], value, tie_break)
    own = df.filter(inside)
    ranks = ranks_of_values(own, value)
    if start in by_position:
        # A value that began in an earlier tier keeps its rank; the others come after all of it.
        first = by_position[start]
        begun = F.col(value).eqNullSafe(F.lit(first.value))
        ranks = ranks.withColumn(
            "rank", F.when(begun, F.lit(first.before + 1)).otherwise(F.col("rank") + start)
        )
    return _with_rank(own, ranks, value).select(
        *[F.col(name) for name in df.columns],
        F.col("rank").cast("bigint").alias(rank_name),
        percent(F.col(value), _total_literal(df, value, cuts.total), share_places).alias(share_name),
    )


def _total_literal(df: DataFrame, value: str, total) -> Column:
    """The grand total as the type that SUM gives."""
    kind = df.select(F.sum(value).alias("t")).schema["t"].dataType
    return F.lit(total).cast(kind)
