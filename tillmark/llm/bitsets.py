"""Bit tables of fixed size that say whether a 64-bit value may be in a set.

They let a scan drop most rows before a shuffle. A table never misses a value that is in the set;
the more values it holds, the more others it lets through, so whoever uses one joins exactly
afterwards. Its size does not depend on the data, which bounds what is collected and broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 33_554_393  # bits; a prime, so that neither consecutive nor regular ids fall together


def bit_table(df: DataFrame, column: str) -> bytes:
    """A table of SIZE bits with the values of a long column."""
    slots = (
        df.select(F.pmod(column, F.lit(SIZE)).alias("slot"))
        .groupBy(F.expr("shiftright(slot, 6)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))
    )
    table = np.zeros(SIZE // 64 + 1, dtype=np.int64)
    found = slots.toArrow()  # at most SIZE / 64 rows
    table[np.asarray(found["word"])] = np.asarray(found["bits"])
    return table.tobytes()


def hit(table: bytes, values: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(table, dtype=np.uint8)
    slots = values % SIZE
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def without_ids(docs: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not in the first column of ``dropped``; nulls are equal.

    Further columns of ``dropped`` must be equal too, to those of the same names.

    Rows that miss the table of dropped keys stay without a join; only the others are shuffled.
    """
    missed, hit_rows, own, same = _split(docs, key, dropped)
    return missed.unionByName(hit_rows.join(own, same, "left_anti"))


def with_ids(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in the first column of ``wanted``, as in ``without_ids``."""
    _, hit_rows, own, same = _split(docs, key, wanted)
    return hit_rows.join(own, same, "left_semi")


def _split(docs: DataFrame, key: str, ids: DataFrame):
    """Rows that miss the table of the ids, rows that hit it, the ids, and when a row has one."""
    name, *others = ids.columns
    table = docs.sparkSession.sparkContext.broadcast(
        bit_table(ids.filter(F.col(name).isNotNull()), name)
    )

    def part_of(uncertain: bool) -> DataFrame:
        def convert(batches):
            for batch in batches:
                keys = batch.column(key)
                values = np.asarray(keys.fill_null(0))
                doubt = hit(table.value, values) | np.asarray(keys.is_null())
                yield batch.filter(pa.array(doubt == uncertain))

        return docs.mapInArrow(convert, docs.schema)

    own = ids.distinct().withColumnsRenamed({c: f"_own_{c}" for c in ids.columns})
    same = F.col(key).eqNullSafe(F.col(f"_own_{name}"))
    for c in others:
        same = same & F.col(c).eqNullSafe(F.col(f"_own_{c}"))
    return part_of(False), part_of(True), own, same
