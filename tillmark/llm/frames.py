"""Small frame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillmark.session import ensure_small_batches

# Small enough for the arrays made from a slice to stay in a core's cache.
BATCH_BYTES = 1 << 19


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, null texts as empty ones; clashing names are left behind."""
    ensure_small_batches(docs.sparkSession)
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def free_name(docs: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have, whatever its case."""
    taken = {name.lower() for name in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bounded(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with a bounded amount of text (or one row)."""
    lengths = np.asarray(pyarrow.compute.binary_length(batch.column(text)).fill_null(0))
    cells = np.cumsum(lengths) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(lengths)]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def with_text_column(docs: DataFrame, text: str, name: str, kind: str, compute) -> DataFrame:
    """All columns of ``docs`` and one more, computed in batches from its texts (null as empty)."""
    ensure_small_batches(docs.sparkSession)

    def convert(batches):
        for batch in batches:
            for part in bounded(batch, text):
                rows = part.column(text).fill_null("").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, compute(rows)], names=[*part.schema.names, name]
                )

    return docs.mapInArrow(convert, StructType([*docs.schema.fields, StructField(name, _parse(kind))]))


def _parse(kind: str):
    return StructType.fromDDL(f"x {kind}")["x"].dataType


def whole_groups(batches, keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by the keys: tables of complete groups, and where each group begins
    (with the row count as last entry). Holds one batch and one group at a time."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        changes = _changes(batch, keys)
        joined = len(rest) > 1 and any(
            rest[0].column(k)[rest[0].num_rows - 1] != batch.column(k)[0] for k in keys
        )
        if len(changes):
            cut = int(changes[-1])
            table = pa.Table.from_batches([*rest[:-1], batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        elif joined:
            table = pa.Table.from_batches(rest[:-1])
            rest = [batch]
        else:
            continue
        yield table, _bounds(table, keys)
    if rest:
        table = pa.Table.from_batches(rest)
        yield table, _bounds(table, keys)


def _changes(rows, keys: list[str]) -> np.ndarray:
    different = np.zeros(max(rows.num_rows - 1, 0), dtype=bool)
    for k in keys:
        values = np.asarray(rows.column(k))
        different |= values[1:] != values[:-1]
    return np.flatnonzero(different) + 1


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    return np.concatenate([[0], _changes(table, keys), [table.num_rows]])
