"""Exact top-k inner-product search by segment statistics, coarse to fine.

A vector is cut into segments; each keeps its mean and its deviation, the norm around the mean.
For two vectors, sum(len * (mean - mean')^2 + (dev - dev')^2) over the segments is at most their
squared distance. With the norms known, score = (|q|^2 + |x|^2 - distance^2) / 2, so a lower bound
of the distance is an upper bound of the score. Few long segments prune first, more short ones
next, and only the survivors get an exact score.

Queries and vectors are dealt into blocks; each pair of a query block and a vector block is one
group of bounded size, whose best k per query are merged afterwards. Vectors are copied once per
query block, queries once per vector block.

Edge cases: vectors that are null or hold a null or non-finite component take no part; vectors
are compared with vectors of their own length only; fully equal rows (id and vector) count once;
an id with several vectors has a list for each; equal scores go to the smaller id; an empty table
gives an empty result; other columns, whatever their names, are left behind. Scores beyond 2^53 are
summed in whole numbers, not doubles; those beyond a long are given, and ranked, as the nearest long.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EXACT = float(1 << 53)


def _segment_stats(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per row: sqrt(len) * mean of each segment, then the deviation of each segment.

    The dot product of two such rows is (|q|^2 + |x|^2 - lower bound of distance^2) / 2.
    """
    width = vectors.shape[1]
    starts = np.unique(np.linspace(0, width, min(segments, width) + 1).astype(int)[:-1])
    lengths = np.diff(np.append(starts, width)).astype(float)
    sums = np.add.reduceat(vectors, starts, axis=1)
    squares = np.add.reduceat(vectors * vectors, starts, axis=1)
    deviations = np.sqrt(np.maximum(squares - sums * sums / lengths, 0))
    return np.hstack([sums / np.sqrt(lengths), deviations])


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    if vectors.size and np.abs(query).sum() * np.abs(vectors).max() >= _EXACT:
        whole = [int(x) for x in query]
        return np.array(
            [sum(int(a) * b for a, b in zip(row, whole)) for row in vectors], dtype=object
        )
    return (vectors @ query).astype(np.int64)


def search_block(
    queries: np.ndarray,
    query_ids: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    k: int,
    levels: Sequence[int] = (4, 16),
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the query, ids, scores) of its best k in the block; ids decide ties."""
    if not vectors.shape[1]:
        levels = ()
    query_norms = np.einsum("ij,ij->i", queries, queries)
    norms = np.einsum("ij,ij->i", vectors, vectors)
    stats = [(_segment_stats(queries, s), _segment_stats(vectors, s)) for s in levels]
    found = []
    for i, query in enumerate(queries):
        alive = np.flatnonzero(ids != query_ids[i])
        floor = -np.inf  # the k-th best exact score so far
        slack = 1e-9 * (query_norms[i] + (norms.max() if len(norms) else 0)) + 1e-6
        for query_stats, vector_stats in stats:
            if len(alive) <= k:
                break
            nearest = query_norms[i] + norms[alive] - 2 * (vector_stats[alive] @ query_stats[i])
            bounds = (query_norms[i] + norms[alive] - nearest) / 2
            likely = alive[np.argpartition(-bounds, k - 1)[:k]]
            floor = max(floor, float(np.min(_exact(vectors[likely], query))))
            alive = alive[bounds >= floor - slack]
        scores = _exact(vectors[alive], query)
        best = np.lexsort((ids[alive], -scores))[:k]
        found.append((i, ids[alive[best]], scores[best]))
    return found


def _rows_of(column: pa.ChunkedArray, rows: int, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(rows, width)


def _as_long(score) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def _search_group(k: int, scale: float):
    def search(group: pa.Table) -> pa.Table:
        wanted = np.asarray(group["is_query"]).astype(bool)
        ids = np.asarray(group["vec_id"])
        width = group["width"][0].as_py()
        vectors = np.floor(_rows_of(group["vector"], len(ids), width) * scale)
        data, data_ids = vectors[~wanted], ids[~wanted]
        places = np.flatnonzero(wanted)
        hits = search_block(vectors[places], ids[places], data, data_ids, k)
        counts = [len(h[1]) for h in hits]
        return pa.table(
            {
                "query_id": np.repeat(ids[places], counts),
                "query_hash": np.repeat(np.asarray(group["hash"])[places], counts),
                "vec_id": np.concatenate([h[1] for h in hits] or [np.zeros(0, np.int64)]),
                "score": pa.array([_as_long(s) for h in hits for s in h[2]], pa.int64()),
            }
        )

    return search


def _up_to(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each query.

    Components are taken as floor(scale * x). Counts both sides while the frame is built.
    """

    def usable(df: DataFrame) -> DataFrame:
        good = df.select(
            F.col(key).cast("long").alias("vec_id"),
            F.col(vector).cast("array<double>").alias("vector"),
        ).filter("vec_id is not null and vector is not null")
        finite = F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
        )
        return good.filter(finite).withColumns(
            {"width": F.size("vector"), "hash": F.xxhash64("vector")}
        )

    data, asked = (usable(df).dropDuplicates(["vec_id", "hash"]) for df in (vectors, queries))
    blocks = max(1, -(-data.count() // block_rows))
    query_blocks = max(1, -(-asked.count() // query_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    query_block = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks))
    dealt = data.select(
        "*",
        F.lit(False).alias("is_query"),
        block.alias("block"),
        F.explode(_up_to(query_blocks)).alias("query_block"),
    ).unionByName(
        asked.select(
            "*",
            F.lit(True).alias("is_query"),
            F.explode(_up_to(blocks)).alias("block"),
            query_block.alias("query_block"),
        )
    )
    best = dealt.groupBy("width", "block", "query_block").applyInArrow(
        _search_group(k, scale), "query_id long, query_hash long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
