"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(id, root): every id of an edge and the smallest id it is connected with.

    ``edges`` has two long columns, a and b. Alternating star contraction: each round links
    larger neighbours to the smallest one, then smaller ones, until nothing changes; the number
    of rounds grows with the logarithm of the longest path. Every round is checkpointed. Edges
    are summed per id before they are shuffled, so an id with very many edges is one row per task.
    """
    links = cut_lineage(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct()
    )
    while True:
        both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
        lowest = both.groupBy("high").agg(F.min("low").alias("best")).select(
            F.col("high").alias("id"), F.least("high", "best").alias("best")
        )
        # Large star: neighbours above an id are linked to the lowest id around it.
        large = (
            links.withColumnRenamed("low", "id")
            .join(lowest, "id")
            .select("high", F.col("best").alias("low"))
            .distinct()
        )
        # Small star: an id and its lower neighbours are linked to the lowest of them.
        least = large.groupBy("high").agg(F.min("low").alias("best"))
        small = (
            large.join(least, "high")
            .select(F.explode(F.array("high", "low")).alias("high"), F.col("best").alias("low"))
            .filter("high <> low")
            .distinct()
        )
        changed = cut_lineage(small)
        mark = F.struct(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")))
        if changed.agg(mark).first() == links.agg(mark).first():
            return changed.select(F.col("high").alias("id"), F.col("low").alias("root")).unionByName(
                changed.select(F.col("low").alias("id"), F.col("low").alias("root")).distinct()
            )
        links = changed
