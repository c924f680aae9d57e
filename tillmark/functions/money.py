"""Exact decimal arithmetic.

Money is DECIMAL throughout. Ratios are rounded half away from zero from the
exact quotient, in integers, so no binary float and no double rounding gets in.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MEAN_SCALE = 14


def round_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """``round(numerator / denominator, places)``; NULL when the denominator is 0.

    Takes integral columns, or decimals with at most 38 digits left after
    multiplying by ``2 * 10**places``. A quotient beyond 18 digits raises.
    """
    top, bottom = F.abs(numerator), F.nullif(F.abs(denominator), F.lit(0))
    units = F.call_function("div", top * (2 * 10**places) + bottom, bottom * 2)
    large = F.abs(numerator).cast("double") / bottom.cast("double") * float(10**places) >= 9e18
    too_long = F.raise_error(F.lit("a ratio has more than 18 digits")).cast("bigint")
    units = F.when(large, too_long).otherwise(units)
    signed = units * F.signum(numerator).cast("bigint") * F.signum(denominator).cast("bigint")
    return signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))


def percent(part: Column, whole: Column, places: int) -> Column:
    return round_ratio(part * 100, whole, places)


def mean(total: Column, count: Column) -> Column:
    """``total / count`` to 14 places, half up, for means that are averaged again."""
    return total.cast(f"decimal(38,{MEAN_SCALE})") / F.nullif(count, F.lit(0))


def line_total(quantity: Column, unit_price: Column) -> Column:
    return F.round(quantity * unit_price, 2)


def discount_amount(total: Column, rate: Column) -> Column:
    return F.round(total * rate, 2)
