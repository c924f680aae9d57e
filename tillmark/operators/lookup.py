"""Dimension lookups that hold up whatever the size of the dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 4096  # counters of the summary of a key, per task and merged
HOTTEST = 64  # keys that may be treated as hot
HOT_BYTES = 8 << 20  # of the dimension's rows for them


def lookup(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join ``facts`` to a dimension with unique ``keys``.

    Spark broadcasts a dimension below its threshold in bytes, by estimate or as measured at run
    time. A larger one is met by a shuffle on the keys, whose large partitions adaptive execution
    splits on the fact side, so that a key with a large share of the facts, identical rows
    included, is met by several tasks.
    """
    _check_kind(how)
    return facts.join(dimension, list(keys), how)


def _check_kind(how: str) -> None:
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"a lookup keeps the fact side: {how}")


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float) -> list[int]:
    """Hashes of the keys that hold at least a ``share`` of the rows, at most ``HOTTEST``.

    A frequent-items summary (Misra-Gries counters) of fixed size is filled by every task and
    merged; with more counters than 1 / share no such key is missed. NULL keys count like others.
    """
    items = F.expr(f"approx_top_k(_key, {HOTTEST}, {TRACKED})")
    found = facts.select(_key(keys).alias("_key")).agg(
        F.count("*").alias("rows"), items.alias("items")
    ).first()
    least = share * found["rows"]
    return [item["item"] for item in found["items"] or [] if item["count"] >= max(least, 1)]


def lookup_skewed(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    share: float | None = None,
) -> DataFrame:
    """``lookup`` for facts some of whose keys hold a large share of the rows.

    Rows with hot keys stay where they are and meet the few rows of the dimension that belong to
    them by broadcast; all others are joined as usual. A key is hot from ``share`` of the rows, by
    default half of what a shuffle partition holds on average. The facts are read three times.
    Should the hot rows of the dimension outgrow ``HOT_BYTES``, everything is joined as usual.
    """
    _check_kind(how)
    spark = facts.sparkSession
    usual = 0.5 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, keys, max(usual if share is None else share, 2 / TRACKED))
    if not hot:
        return lookup(facts, dimension, keys, how)
    is_hot = _key(keys).isin(hot)
    few = dimension.filter(is_hot)
    size = few.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size > HOT_BYTES:
        return lookup(facts, dimension, keys, how)
    heavy = facts.filter(is_hot).join(F.broadcast(few), list(keys), how)
    light = lookup(facts.filter(~is_hot), dimension.filter(~is_hot), keys, how)
    return heavy.unionByName(light)


def _key(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)
