"""Sampling from tables and within groups, driven by hash-seeded draws.

A draw table holds one row per wanted sample and an integer draw column below
``DRAW_SPACE`` (see ``functions.draws``). Picks never depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.draws import DRAW_SPACE, happens
from tillmark.functions.text import map_value
from tillmark.operators.lookup import lookup
from tillmark.operators.ordering import with_row_number, with_running_total
from tillmark.operators.ranking import with_ranks


def normalise_weights(df: DataFrame, weight: str, name: str) -> DataFrame:
    """Append the weight as a share of the column's total, as a double."""
    total = df.agg(F.sum(weight).cast("double")).scalar()
    return df.withColumn(name, F.col(weight).cast("double") / total)


def member_index(df: DataFrame, group: str, member: str) -> DataFrame:
    """Append each member's 1-based index in its group and its position in the whole table.

    Members are numbered across the table by (group, member) and the group's
    first number is taken off, so that a group with a third of all members is
    still spread over many tasks.
    """
    ranked = with_ranks(df, group, [member], descending=False)
    return (
        ranked.withColumn("member_index", F.col("row_number") - F.col("rank") + 1)
        .withColumnRenamed("row_number", "position")
        .drop("rank", "rows")
    )


def _positions(members: DataFrame, group: str, member: str) -> DataFrame:
    """Members with their position in the whole table, by group and member."""
    order = [F.col(group).asc_nulls_last(), F.col(member).asc()]
    return with_row_number(members.select(group, member), order, "position")


def group_spans(indexed: DataFrame, group: str) -> DataFrame:
    """First position and size of each group of ``member_index``."""
    return indexed.groupBy(group).agg(
        F.min("position").alias("group_start"), F.count("*").alias("group_size")
    )


def uniform_pick(
    draws: DataFrame, draw: str, group: str, members: DataFrame, member: str
) -> DataFrame:
    """Append to each draw a member of its group, all equally likely.

    Draws whose group has no members are dropped. ``group`` is a column of both
    tables.
    """
    indexed = _positions(members, group, member)
    spans = group_spans(indexed, group)
    placed = lookup(draws, spans, [group]).withColumn(
        "position", F.col("group_start") + F.col(draw) % F.col("group_size")
    )
    picked = lookup(placed, indexed.select("position", member), ["position"])
    return picked.select(*draws.columns, member)


def affinity_assign(
    draws: DataFrame,
    chance: str,
    draw: str,
    group: str,
    members: DataFrame,
    member: str,
    probability: float | str = "0.90",
) -> DataFrame:
    """Append a member: of the draw's own group with the given probability, else of all.

    Groups without members always draw from all. ``chance`` and ``draw`` are
    independent draw columns.
    """
    indexed = _positions(members, group, member)
    everyone = indexed.agg(F.count("*")).scalar()
    own = happens(F.col(chance), probability) & F.col("group_size").isNotNull()
    target = F.when(own, F.col("group_start") + F.col(draw) % F.col("group_size")).otherwise(
        1 + F.col(draw) % everyone
    )
    placed = lookup(draws, group_spans(indexed, group), [group], "left")
    picked = lookup(
        placed.withColumn("position", target), indexed.select("position", member), ["position"]
    )
    return picked.select(*draws.columns, member)


def weighted_sample(
    draws: DataFrame,
    draw: str,
    key: Sequence[str],
    table: DataFrame,
    item: str,
    weight: str,
) -> DataFrame:
    """Append to each draw an item, with replacement, in proportion to its weight.

    ``weight`` is DECIMAL or integral, ``item`` unique, ``key`` identifies a draw.
    Weights below 0 or NULL raise; those of 0 are never drawn. The weights are laid end to end and
    the line is cut into as many equal cells as there are items; a draw looks its item up in its
    cell (``line_cells``). Draws are neither sorted nor written, and as cells are equally long they
    spread evenly over the cells, whatever the weights.
    """
    units = _whole_units(table, item, weight)
    length, items = _total_weight(units, weight)
    cells, width = line_cells(units.filter("_units > 0"), item, length, items)
    at = F.call_function("div", F.col(draw).cast("decimal(38,0)") * length, F.lit(DRAW_SPACE))
    points = draws.withColumn("_at", at)
    own = (F.call_function("div", F.col("_at"), F.lit(width)) == F.col("_cell")) & (
        (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    )
    return points.join(cells, own).select(*draws.columns, item)


_BLOCK = 4096


def line_cells(
    units: DataFrame, item: str, length: Decimal, items: int
) -> tuple[DataFrame, int]:
    """The part of each item (``item``, ``_units``) in each cell of the line: ``_cell``, ``_from``,
    ``_to``; and the width of a cell.

    Items lie in their own order. With as many cells as items there are at most twice as many parts,
    and a point meets two of them on average. The cells of a long item come in blocks, so that no
    row holds more than some thousand of them.
    """
    width = int(-(-length // items))
    line = with_running_total(units, [F.col(item)], "_units", "_end")
    parts = line.select(
        item,
        (F.col("_end") - F.col("_units")).cast("bigint").alias("_from"),
        F.col("_end").cast("bigint").alias("_to"),
    )
    first = F.call_function("div", F.col("_from"), F.lit(width))
    last = F.call_function("div", F.col("_to") - 1, F.lit(width))
    blocks = F.sequence(F.shiftright(first, 12), F.shiftright(last, 12))
    inside = F.sequence(
        F.greatest(first, F.col("_block") * _BLOCK),
        F.least(last, F.col("_block") * _BLOCK + (_BLOCK - 1)),
    )
    cells = parts.withColumn("_block", F.explode(blocks)).withColumn("_cell", F.explode(inside))
    return cells.drop("_block"), width


def two_stage_pick(
    draws: DataFrame,
    group_draw: str,
    member_draw: str,
    key: Sequence[str],
    members: DataFrame,
    group: str,
    member: str,
    weights: Mapping[str, float | str] | None = None,
    default_weight: float | str = "1.0",
) -> DataFrame:
    """Append a group chosen by weight, then a member chosen uniformly inside it.

    Groups absent from ``weights`` weigh ``default_weight``.
    """
    exact = {name: Decimal(str(value)) for name, value in (weights or {}).items()}
    plain = F.lit(Decimal(str(default_weight))).cast("decimal(12,4)")
    found = map_value(F.col(group), exact).cast("decimal(12,4)") if exact else F.lit(None)
    groups = (
        members.select(group)
        .filter(F.col(group).isNotNull())
        .distinct()
        .withColumn("_weight", F.coalesce(found, plain))
    )
    chosen = weighted_sample(draws, group_draw, key, groups, group, "_weight")
    return uniform_pick(chosen, member_draw, group, members, member)


def next_keys(
    new_rows: DataFrame, order: Sequence[Column], existing: DataFrame, key: str
) -> DataFrame:
    """Append surrogate keys that continue after the highest existing one.

    As after resetting a sequence, an empty table counts as having key 1.
    """
    highest = existing.agg(F.coalesce(F.max(key), F.lit(1)).cast("bigint").alias("m")).scalar()
    numbered = with_row_number(new_rows, order, "_number")
    return numbered.withColumn(key, highest + F.col("_number")).drop("_number")


def _total_weight(units: DataFrame, weight: str) -> tuple[Decimal, int]:
    """The sum of the units, and how many are above 0; raises when a weight is below 0 or NULL, or
    none is left."""
    total, items, wrong = units.agg(
        F.sum("_units"),
        F.count_if(F.col("_units") > 0),
        F.count_if(F.col("_units").isNull() | (F.col("_units") < 0)),
    ).first()
    if wrong:
        raise ValueError(f"{wrong} weights in {weight} are below 0 or NULL")
    if not total:
        raise ValueError(f"no weight in {weight} is above 0")
    return total, items


def _whole_units(table: DataFrame, item: str, weight: str) -> DataFrame:
    """Weights as integers of the weight's smallest unit."""
    kind = table.schema[weight].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        raise TypeError(f"cast {weight} to DECIMAL first")
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    units = (F.col(weight) * F.lit(10**scale)).cast("decimal(20,0)")
    return table.select(item, units.alias("_units"))
