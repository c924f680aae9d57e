from __future__ import annotations

import pyarrow as pa
import pytest
import samples
from pyspark.sql import functions as F

from tillmark.llm import frames
from tillmark.session import BATCH_SETTING

MOST = 5 << 20


def largest_batch(docs):
    """Rows of all batches that reach Python, and the bytes of the largest one."""

    def convert(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"]
            )

    sizes = docs.mapInArrow(convert, "n long, size long")
    return tuple(sizes.agg(F.sum("n"), F.max("size")).first())


@pytest.fixture
def plain(spark):
    """A session that nobody has given a bound."""
    own = spark.newSession()
    own.conf.unset(BATCH_SETTING)
    return own


def long_texts(session, rows=3000):
    number = F.col("id")
    return session.range(0, rows, 1, 1).select(
        number.alias("doc_id"), F.repeat(F.md5(number.cast("string")), 200).alias("text")
    )


def test_texts_go_to_python_in_small_batches(plain):
    docs = long_texts(plain)
    rows, size = largest_batch(frames.texts(docs))
    assert rows == 3000 and 1 << 20 < size < MOST


def test_text_columns_are_computed_in_small_batches(plain):
    docs = frames.with_text_column(
        long_texts(plain), "text", "length", "long", lambda rows: pa.array(list(map(len, rows)))
    )
    rows, size = largest_batch(docs)
    assert rows == 3000 and size < MOST
    assert docs.filter("length <> 6400").isEmpty()


def test_the_bound_of_a_session_stays(plain):
    plain.conf.set(BATCH_SETTING, "256k")
    rows, size = largest_batch(frames.texts(long_texts(plain, 300)))
    assert rows == 300 and size < 1 << 19


def test_a_row_above_the_bound_is_a_batch(plain):
    docs = samples.documents(plain, [(1, "a" * (MOST + 1)), (2, None), (3, "b")])
    assert largest_batch(frames.texts(docs))[0] == 3
