"""Random-looking draws that depend only on the seed, a stream name and the row key.

A draw is an integer below 2**52 taken from an MD5 digest, so the result is the
same for any partitioning, any retry and any engine that has MD5.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction
from math import ceil

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_DIGITS = 13
DRAW_SPACE = 16**DRAW_DIGITS


def draw(seed: int, stream: str, *key: Column) -> Column:
    text = F.concat_ws(":", F.lit(f"{seed}:{stream}"), *[part.cast("string") for part in key])
    return F.conv(F.substring(F.md5(text), 1, DRAW_DIGITS), 16, 10).cast("bigint")


def happens(draw_column: Column, probability: float | str | Decimal) -> Column:
    """True for the given share of draws."""
    return draw_column < ceil(Fraction(str(probability)) * DRAW_SPACE)


def uniform_int(draw_column: Column, low: int, high: int) -> Column:
    """An integer from ``low`` to ``high``, both included."""
    return low + draw_column % (high - low + 1)


def uniform_decimal(draw_column: Column, low: str, high: str) -> Column:
    """A six-place decimal from ``low`` to ``high``, both included."""
    ends = [int(Decimal(end).scaleb(6)) for end in (low, high)]
    return uniform_int(draw_column, *ends).cast("decimal(18,0)") * F.lit(Decimal("0.000001"))


def thresholds(weights: Sequence[float | str | int | Decimal]) -> list[int]:
    """The smallest draw beyond each item's share, in item order."""
    shares = [Fraction(str(weight)) for weight in weights]
    total, reached, bounds = sum(shares), Fraction(0), []
    for share in shares:
        reached += share
        bounds.append(ceil(reached * DRAW_SPACE / total))
    return bounds


def weighted_choice(draw_column: Column, items: Sequence, weights: Sequence) -> Column:
    """One of a short literal list, each item in proportion to its weight."""
    if not items or len(items) != len(weights):
        raise ValueError("items and weights must be non-empty and of equal length")
    bounds = thresholds(weights)
    chosen = None
    for item, bound in zip(items, bounds):
        hit = draw_column < bound
        chosen = F.when(hit, F.lit(item)) if chosen is None else chosen.when(hit, F.lit(item))
    return chosen


def pick_in_ranges(
    range_draw: Column, value_draw: Column, ranges: Sequence[tuple[int, int]]
) -> Column:
    """First one of the integer ranges, each equally likely, then a value inside it."""
    picked = None
    for index, (low, high) in enumerate(ranges):
        hit = (range_draw % len(ranges)) == index
        value = uniform_int(value_draw, low, high)
        picked = F.when(hit, value) if picked is None else picked.when(hit, value)
    return picked
