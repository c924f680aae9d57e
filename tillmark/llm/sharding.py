"""Shards of near-equal bytes: a minimax contiguous partition of atomic groups.

Equal texts are one atomic group. Groups stand in the order of their digest, which spreads
sources and sizes evenly. The smallest capacity for which a greedy left-to-right fill needs at
most the wanted number of shards is found by search, and the fill at that capacity gives the cuts.

Native: DataFrame functions only. The fill of one capacity takes one aggregate per shard, which
looks for the furthest running total within reach; a whole ladder of capacities goes through it
at once. The k-th cut moves right as the capacity grows, so after each round only groups between
the cuts of the two nearest rungs can still matter. When those are few (a fixed bound) they are
fetched and the search ends on the driver; until then the ladder goes on in Spark.

Edge cases: a null text counts as empty (size 1); repeated rows are rows of their own; an empty
table gives an empty result; a group larger than its fair share gets a shard of its own size and
sets the capacity; with fewer groups than shards, the last shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.operators.ordering import with_running_total
from tillmark.session import cut_lineage

RUNGS = 12
CELLS = 1024


def _next_ends(totals: list[int], capacity: int, shards: int) -> list[int]:
    ends, at = [], 0
    for _ in range(shards):
        place = bisect_right(totals, at + capacity)
        at = max(at, totals[place - 1]) if place else at
        ends.append(at)
    return ends


def _fill(running: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """The ends of each shard of the greedy fill, for each capacity."""
    at = [0] * len(capacities)
    ends: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        reach = [a + c for a, c in zip(at, capacities)]
        row = (
            running.filter(F.col("upto").between(min(at), max(reach)))
            .agg(*[F.max(F.when(F.col("upto") <= r, F.col("upto"))) for r in reach])
            .first()
        )
        at = [a if found is None else max(a, found) for a, found in zip(at, row)]
        for own, a in zip(ends, at):
            own.append(a)
    return ends


def smallest_capacity(
    running: DataFrame, total: int, largest: int, shards: int, driver_groups: int = 50_000
) -> tuple[int, list[int]]:
    """The minimax capacity and its shard ends.

    ``running`` has one row per atomic group with its running total ``upto``. At most
    ``driver_groups`` totals are ever fetched.
    """
    fair = -(-total // shards)
    low, high = max(fair, largest), fair + largest
    relevant = running
    while True:
        step = max(1, -(-(high - low) // RUNGS))
        ladder = sorted({*range(low, high, step), high})
        filled = _fill(relevant, ladder, shards)
        first = next(i for i, ends in enumerate(filled) if ends[-1] == total)
        if first == 0 or ladder[first] - ladder[first - 1] == 1:
            return ladder[first], filled[first]
        low, high = ladder[first - 1] + 1, ladder[first]
        between = F.lit(False)
        for start, end in zip(filled[first - 1], filled[first]):
            between = between | F.col("upto").between(start, end)
        relevant = running.filter(between)
        fetched = relevant.select("upto").limit(driver_groups + 1).collect()
        if len(fetched) <= driver_groups:
            totals = sorted(row[0] for row in fetched)
            while low < high:
                middle = (low + high) // 2
                if _next_ends(totals, middle, shards)[-1] == total:
                    high = middle
                else:
                    low = middle + 1
            return low, _next_ends(totals, low, shards)


def pack_shards(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = 8,
    driver_groups: int = 50_000,
) -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    Runs jobs while the frame is built (digests, running totals, the capacity search).
    """
    words = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = cut_lineage(
        docs.select(
            F.col(key).alias("_key"),
            (F.octet_length(words).cast("long") + 1).alias("_size"),
            F.crc32(words.cast("binary")).alias("_crc"),
            F.unhex(F.sha2(words, 256)).alias("_digest"),
        )
    )
    groups = base.groupBy("_digest").agg(F.sum("_size").alias("_bytes"))
    running = cut_lineage(
        with_running_total(groups, [F.col("_digest")], "_bytes", "upto").select(
            "_digest", "_bytes", "upto"
        )
    )
    total, largest = running.agg(F.max("upto"), F.max("_bytes")).first()
    last_digests: list[bytes] = []
    if total is not None:
        _, ends = smallest_capacity(running, total, largest, shards, driver_groups)
        cuts = sorted({end for end in ends if end < total})
        rows = running.filter(F.col("upto").isin(cuts)).select("_digest").collect() if cuts else []
        last_digests = sorted(bytes(row[0]) for row in rows)
    return _numbered(base, key, _shard_of(last_digests))


def _shard_of(last_digests: list[bytes]) -> Column:
    """Shards before it: those whose last group comes before this one."""
    shard = F.lit(0)
    for last in last_digests:
        shard = shard + F.when(F.col("_digest") > F.lit(bytearray(last)), 1).otherwise(0)
    return shard.cast("int")


def _numbered(base: DataFrame, key: str, shard: Column) -> DataFrame:
    """Slots without a gap in each shard, counted in cells of hashed rows: a shard or a group of
    copies is never numbered in one task, and the offsets are at most shards x CELLS rows."""
    placed = base.withColumns(
        {"_shard": shard, "_cell": F.pmod(F.xxhash64("_key", "_digest"), F.lit(CELLS))}
    )
    before = Window.partitionBy("_shard").orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        placed.groupBy("_shard", "_cell")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_shard", "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
        )
    )
    inside = Window.partitionBy("_shard", "_cell").orderBy("_key", "_digest")
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), ["_shard", "_cell"])
        .select(
            F.col("_key").alias(key),
            F.col("_size").alias("size"),
            F.col("_crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            F.col("_shard").alias("shard"),
            (F.col("_offset") + F.col("_place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
