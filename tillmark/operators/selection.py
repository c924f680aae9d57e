"""Exact selection of rows by their position in an order, without ordering the rows.

Histograms close in on the value at a position. Every task counts its rows per cell, and the driver
sees one line per cell: first of logarithmic cells, whose number depends on the type alone, then of
``CELLS`` equal cells inside the one that holds the position, until a cell is a single value. Rows
of that value which stand on both sides of the position are told apart by their tie break, found
in the same way. The table is read once per step, nothing but counts is shuffled, and there are
as many steps for a thousand rows as for a billion.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.ordering import with_row_number

CELLS = 1 << 15
_PER_OCTAVE = 64


@dataclass(frozen=True)
class Cut:
    """Where the first ``position`` rows of an order end.

    ``value`` is that of the last one (None for NULL), ``before`` and ``equal`` count the rows that
    come before that value and those that have it. ``tie`` is the tie break of the last one, or
    None when all rows of the value are among the first.
    """

    position: int
    value: int | Decimal | None
    before: int
    equal: int
    tie: tuple | None = None


@dataclass(frozen=True)
class Cuts:
    """Cuts of one table, and its number of rows and the sum of its values."""

    cuts: list[Cut]
    rows: int
    total: int | Decimal | None


def until(cut: Cut, value: str, tie_break: Sequence[str], descending: bool = True) -> Column:
    """Whether a row is among the first rows that the cut ends."""
    column = F.col(value)
    tied = F.lit(True)
    if cut.tie is not None:
        tied = F.struct(*tie_break) <= F.struct(
            *[F.lit(part).alias(name) for part, name in zip(cut.tie, tie_break)]
        )
    if cut.value is None:
        # NULLs come first when descending and last otherwise.
        return column.isNull() & tied if descending else column.isNotNull() | tied
    end = F.lit(cut.value)
    early = column > end if descending else column < end
    inside = F.coalesce(early | ((column == end) & tied), F.lit(False))
    return column.isNull() | inside if descending else inside


def cuts_at(
    df: DataFrame,
    value: str,
    tie_break: Sequence[str],
    positions: Callable[[int], Sequence[int]],
    descending: bool = True,
) -> Cuts:
    """The cuts at 1-based positions, given as a function of the number of rows.

    The order is ``value`` (NULLs first when descending, else last), then ``tie_break`` ascending;
    both together are unique. ``value`` is DECIMAL or integral. ``df`` is read several times: store
    it first if that is dear.
    """
    unit, scale = _whole(df, value)
    sign = -1 if descending else 1
    keyed = df.select((unit * sign).alias("_unit"), F.col(value).alias("_value"))
    first = (
        keyed.groupBy(_logarithmic(F.col("_unit")).alias("_cell"))
        .agg(
            F.count("*").alias("rows"),
            F.min("_unit").alias("low"),
            F.max("_unit").alias("high"),
            F.sum("_value").alias("total"),
        )
        .collect()
    )
    rows = sum(line["rows"] for line in first)
    sums = [line["total"] for line in first if line["total"] is not None]
    nulls = sum(line["rows"] for line in first if line["_cell"] is None)
    cells = sorted((int(line["low"]), int(line["high"]), line["rows"])
                   for line in first if line["_cell"] is not None)
    lead = nulls if descending else 0
    wanted = [position for position in positions(rows) if 0 < position <= rows]
    ends = {p for p in wanted if lead < p <= rows - nulls + lead}
    found = _close_in(keyed, cells, {p: p - lead for p in ends})
    cuts = []
    for position in wanted:
        if position in ends:
            number, before, equal = found[position]
            own = _as_value(sign * number, scale)
            cut = Cut(position, own, before + lead, equal)
        else:
            cut = Cut(position, None, 0 if descending else rows - nulls, nulls)
        cuts.append(_with_tie(df, value, tie_break, cut))
    return Cuts(cuts, rows, sum(sums) if sums else None)


def _with_tie(df: DataFrame, value: str, tie_break: Sequence[str], cut: Cut) -> Cut:
    place = cut.position - cut.before
    if place == cut.equal:
        return cut
    same = F.col(value).isNull() if cut.value is None else F.col(value) == F.lit(cut.value)
    tied = df.filter(same).select(*tie_break)
    kind = tied.schema[tie_break[0]].dataType
    if len(tie_break) == 1 and isinstance(kind, T.IntegralType):
        line = cuts_at(tied, tie_break[0], [], lambda rows: [place], descending=False).cuts[0]
        tie = (line.value,)
    else:
        order = [F.col(name) for name in tie_break]
        last = with_row_number(tied, order, "_number").filter(F.col("_number") == place)
        tie = tuple(last.select(*tie_break).first())
    return Cut(cut.position, cut.value, cut.before, cut.equal, tie)


def _whole(df: DataFrame, value: str) -> tuple[Column, int]:
    """The value in its smallest units, and how many decimals that takes off."""
    kind = df.schema[value].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(value).cast("decimal(38,0)"), 0
    if not isinstance(kind, T.DecimalType):
        raise TypeError(f"cast {value} to DECIMAL first")
    shifted = F.col(value) * F.lit(Decimal(10**kind.scale))
    return shifted.cast("decimal(38,0)"), kind.scale


def _as_value(units: int, scale: int) -> int | Decimal:
    return Decimal(f"{units}e{-scale}") if scale else units


def _logarithmic(unit: Column) -> Column:
    """A cell that never falls as the unit rises; some hundred cells per power of ten."""
    number = unit.cast("double")
    return F.floor(F.log2(F.abs(number) + 1) * _PER_OCTAVE) * F.signum(number)


def _close_in(keyed: DataFrame, cells: list[tuple[int, int, int]], places: dict[int, int]) -> dict:
    """(unit, rows before it, rows that have it) for each 1-based place among the units.

    ``cells`` are (lowest unit, highest unit, rows) in order and without gaps in the rows.
    """
    found, open_at = {}, {}
    for position, place in places.items():
        open_at[position] = _cell_of(cells, place, 0)
    while True:
        for position, (low, high, before, rows) in list(open_at.items()):
            if low == high:
                found[position] = (low, before, rows)
                del open_at[position]
        if not open_at:
            return found
        spans = sorted({(low, high, before) for low, high, before, _ in open_at.values()})
        lines = _counted(keyed, [span[:2] for span in spans])
        for position, (low, high, before, _) in open_at.items():
            own = lines[spans.index((low, high, before))]
            open_at[position] = _cell_of(own, places[position], before)


def _cell_of(cells: list[tuple[int, int, int]], place: int, before: int) -> tuple:
    for low, high, rows in cells:
        if place <= before + rows:
            return low, high, before, rows
        before += rows
    raise ValueError("the table changed between two readings")


def _counted(keyed: DataFrame, spans: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """For each span of units, its cells as (lowest unit met, highest unit met, rows)."""
    cell = F.lit(None).cast("long")
    for number, (low, high) in enumerate(spans):
        width = -(-(high - low + 1) // CELLS)
        inside = F.call_function("div", F.col("_unit") - F.lit(Decimal(low)), F.lit(Decimal(width)))
        within = F.col("_unit").between(F.lit(Decimal(low)), F.lit(Decimal(high)))
        cell = F.when(within, inside + number * CELLS).otherwise(cell)
    lines = (
        keyed.select("_unit", cell.alias("_cell"))
        .filter(F.col("_cell").isNotNull())
        .groupBy("_cell")
        .agg(F.min("_unit").alias("low"), F.max("_unit").alias("high"), F.count("*").alias("rows"))
        .collect()
    )
    counted: list[list] = [[] for _ in spans]
    for line in sorted(lines, key=lambda line: line["_cell"]):
        counted[line["_cell"] // CELLS].append((int(line["low"]), int(line["high"]), line["rows"]))
    return counted
