"""A table whose rows are put together from two, without having been put together yet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Joined:
    """The rows of ``lines.join(heads, key)``, of which the key itself is no column.

    Whoever takes the parts can drop what it does not need of each before they meet.
    """

    lines: DataFrame
    heads: DataFrame
    key: str

    @property
    def columns(self) -> list[str]:
        own = [name for name in self.lines.columns if name != self.key]
        return own + [name for name in self.heads.columns if name != self.key]

    def rows(self) -> DataFrame:
        return self.lines.join(self.heads, self.key).select(*self.columns)
