"""Text expressions: names, contact details, parts of texts, literal maps."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column, last: Column) -> Column:
    # concat, not concat_ws: a missing part makes the whole name NULL.
    return F.concat(first, F.lit(" "), last)


def initials(first: Column, last: Column) -> Column:
    return F.upper(F.concat(F.substring(first, 1, 1), F.substring(last, 1, 1)))


def after(text: Column, mark: str) -> Column:
    """What follows the last ``mark``; the whole text without one."""
    return F.substring_index(text, mark, -1)


def email_address(first: Column, last: Column, number: Column, host: str) -> Column:
    user = F.concat(F.lower(first), F.lit("."), F.lower(last), number.cast("string"))
    return F.concat(user, F.lit(f"@{host}"))


def mobile_number(area: Column, middle: Column, end: Column) -> Column:
    number = F.format_string("04%02d %03d %03d", area, middle, end)
    return F.when(area.isNotNull() & middle.isNotNull() & end.isNotNull(), number)


def padded(number: Column, width: int) -> Column:
    return F.format_string(f"%0{width}d", number)


def region_type(suburb: Column, metro_by_chance: Column, central: str = "CBD") -> Column:
    """Central districts are always Metro, the rest by the given condition."""
    return F.when(suburb.contains(central) | metro_by_chance, "Metro").otherwise("Regional")


def map_value(key: Column, mapping: Mapping, default=None) -> Column:
    """Look a key up in a short literal map."""
    literal = F.create_map(*[F.lit(part) for part in chain.from_iterable(mapping.items())])
    found = F.try_element_at(literal, key)
    return found if default is None else F.coalesce(found, F.lit(default))
