"""Rows that repeat the one before them in a global order, found without joining or grouping."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tillmark.operators.ordering import BUCKET, SLOT, in_buckets


def with_again(df: DataFrame, equal: list[str], order: list[str]) -> DataFrame:
    """Append ``again``: whether an earlier row, by ``order``, has the same ``equal`` columns.

    Both together are unique and not null. Rows are sorted over all tasks and written, so a value
    with very many rows lies in as many tasks as its rows fill; what a task has to know is the last
    row of the one before it, of which there is one per task.
    """
    placed = in_buckets(df, [F.col(name).asc() for name in (*equal, *order)])
    ends = placed.groupBy(BUCKET).agg(F.max_by(F.struct(*equal), SLOT).alias("end")).collect()
    ends = sorted((row[BUCKET], tuple(_plain(value) for value in row["end"])) for row in ends)
    before = {bucket: end for (_, end), (bucket, _) in zip(ends, ends[1:])}
    shared = df.sparkSession.sparkContext.broadcast(before)
    names = df.columns

    def convert(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                last = shared.value.get(batch.column(BUCKET)[0].as_py())
            own = [batch.column(name) for name in equal]
            again = np.ones(batch.num_rows, dtype=bool)
            again[0] = last == tuple(column[0].as_py() for column in own)
            for column in own:
                again[1:] &= np.asarray(pc.equal(column[1:], column[:-1]))
            last = tuple(column[-1].as_py() for column in own)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in names], pa.array(again)], names=[*names, "again"]
            )

    schema = StructType([*df.schema.fields, StructField("again", BooleanType())])
    return placed.mapInArrow(convert, schema)


def _plain(value):
    return bytes(value) if isinstance(value, bytearray) else value
