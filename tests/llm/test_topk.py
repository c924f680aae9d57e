from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, block string, rank string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in vectors], SCHEMA)


def plain(vectors, queries, k):
    good = []
    for i, v in dict.fromkeys((i, tuple(v)) for i, v in vectors if i is not None and v is not None
                              and all(x is not None and np.isfinite(x) for x in v)):
        good.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = set()
    for q, w in good:
        if q in queries:
            scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, v in good
                      if i != q and len(v) == len(w)]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize("block", [8192, 7])
def test_brute_force(spark, block):
    draw = np.random.default_rng(0)
    vectors = [(i, draw.normal(0, 0.3, 24).tolist()) for i in range(120)]
    vectors += [(200 + i, vectors[3][1]) for i in range(12)]  # ties
    vectors += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 24), (None, [0.5] * 24),
                (303, [float("inf")] * 24), (304, [1.0, 2.0]), (305, [2.0, 1.0]), (306, []), (307, [])]
    vectors.append(vectors[5])
    df = frame(spark, vectors)
    wanted = {0, 3, 50, 100, 205, 304, 306, 302}
    got = topk.top_k(df, df.filter(F.col("vec_id").isin(*wanted)), block_rows=block, query_rows=3)
    assert {tuple(r) for r in got.collect()} == plain(vectors, wanted, 5)


def test_ids_beyond_doubles(spark):
    big = 2**53
    df = frame(spark, [(0, [0.5]), (big, [1.0]), (big + 1, [1.0]), (big + 1, [1.0])])
    got = topk.top_k(df, df.filter("vec_id = 0")).collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, big), (2, big + 1)]


def test_scores_beyond_a_long(spark):
    rows = [(1, [1e18]), (2, [1e18]), (3, [-1e18])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.filter("vec_id = 1")).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 2**63 - 1), (3, -(2**63))]


def test_scores_beyond_doubles():
    query = np.array([[2.0**40, 1.0]])
    vectors = np.array([[2.0**40, 1.0], [2.0**40, 3.0], [2.0**40, 2.0]])
    (_, ids, scores), = topk.search_block(query, np.array([9]), vectors, np.array([1, 2, 3]), 2)
    assert ids.tolist() == [2, 3] and scores.tolist() == [2**80 + 3, 2**80 + 2]


def test_bounds_hold():
    draw = np.random.default_rng(1)
    a, b = draw.normal(0, 9, (2, 200, 33))
    for segments in (1, 4, 16, 40):
        bound = (topk._segment_stats(a, segments) * topk._segment_stats(b, segments)).sum(axis=1)
        assert (bound >= (a * b).sum(axis=1) - 1e-6).all()


def test_empty(spark):
    df = frame(spark, [])
    assert topk.top_k(df, df).collect() == []
