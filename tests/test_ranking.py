from __future__ import annotations

import random

import pytest
from parity import bag
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillmark.operators import ordering
from tillmark.operators.ranking import one_tier, spend_tiers, tile_ends, with_ranks
from tillmark.operators.selection import cuts_at, until

SCHEMA = "id bigint, spend decimal(18,2)"


def table(spark, values):
    from decimal import Decimal

    rows = [(i, None if v is None else Decimal(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(df, tiers):
    """The same columns from one-task windows."""
    order = [F.col("spend").desc_nulls_first(), F.col("id")]
    return df.select(
        "id",
        F.ntile(tiers).over(Window.orderBy(*order)).cast("bigint"),
        F.rank().over(Window.orderBy(order[0])).cast("bigint"),
    )


def ours(df, tiers):
    return spend_tiers(df, "spend", ["id"], tiers).select("id", "spend_quartile", "spend_rank")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7])
def test_tiles_of_few_rows(spark, n):
    df = table(spark, [10 * i for i in range(n)])
    assert bag(ours(df, 4)) == bag(plain(df, 4))


def test_equals_plain_windows_for_any_partitioning(spark, partitions):
    rng = random.Random(5)
    df = table(spark, [rng.choice([None, *range(40)]) for _ in range(2003)])
    assert bag(ours(df, 4)) == bag(plain(df, 4))


def test_one_value_held_by_most_rows_spans_buckets(spark):
    values = [7] * 1500 + list(range(8, 300)) + [3] * 700 + list(range(3))
    df = table(spark, values)
    assert bag(ours(df, 5)) == bag(plain(df, 5))
    placed = ordering.in_buckets(df, [F.col("spend").desc(), F.col("id")])
    sizes = [r["count"] for r in placed.groupBy(ordering.BUCKET).count().collect()]
    assert len(sizes) > 4 and max(sizes) < len(values) / 2


def test_all_values_equal(spark):
    df = table(spark, [5] * 400)
    assert bag(ours(df, 4)) == bag(plain(df, 4))


def test_rank_has_gaps_after_ties(spark):
    ranked = ours(table(spark, [9, 9, 4]), 4)
    assert [row[2] for row in bag(ranked)] == [1, 1, 3]


def test_ascending_ranks(spark):
    df = table(spark, [3, 1, 1, 2, None])
    got = with_ranks(df, "spend", ["id"], descending=False).select("id", "rank", "row_number")
    assert bag(got) == [(0, 4, 4), (1, 1, 1), (2, 1, 2), (3, 3, 3), (4, 5, 5)]


def test_share_is_of_the_whole_table(spark):
    from decimal import Decimal

    df = table(spark, [100, 200, 700])
    shares = {r.id: r.pct_of_total_revenue for r in spend_tiers(df, "spend", ["id"]).collect()}
    assert shares == {0: Decimal("10.00"), 1: Decimal("20.00"), 2: Decimal("70.00")}


def test_doubles_are_refused(spark):
    with pytest.raises(TypeError):
        spend_tiers(spark.range(3).withColumn("x", F.lit(1.5)), "x", ["id"])


def test_row_numbers_and_running_totals(spark, partitions):
    df = spark.range(1000).withColumn("v", F.col("id") % 7).repartition(3)
    numbered = ordering.with_row_number(df, [F.col("id").desc()], "n")
    assert all(row.n == 1000 - row.id for row in numbered.collect())
    total, expected = ordering.with_running_total(df, [F.col("id")], "v", "t"), {}
    reached = 0
    for i in range(1000):
        reached += i % 7
        expected[i] = reached
    assert {row.id: row.t for row in total.collect()} == expected


def test_last_seen_is_carried_over_buckets(spark, partitions):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 333 == 10, F.col("id")))
    seen = ordering.with_last_seen(df, [F.col("id")], "v", "s").collect()
    for row in seen:
        assert row.s == (None if row.id < 10 else (row.id - 10) // 333 * 333 + 10)


def test_only_bucket_summaries_are_ordered_in_one_task(spark):
    ranked = spend_tiers(table(spark, range(50)), "spend", ["id"])
    lines = ranked._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert all("keys=[_bucket" in lines[i + 1] for i in single)


def test_rows_are_shuffled_once_and_never_ordered(spark, tmp_path, small_limits):
    table(spark, [i % 30 for i in range(400)]).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for ranked in (spend_tiers(stored, "spend", ["id"]), one_tier(stored, "spend", ["id"])):
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
        assert plan.count("FileScan parquet") == 1  # the rows, joined to written ranks


@pytest.mark.parametrize("tier", [1, 3])
def test_one_tier_is_a_part_of_all(spark, tier):
    rng = random.Random(tier)
    for values in (
        [rng.choice([None, *range(-20, 20)]) for _ in range(301)],
        [None] * 200 + [4] * 150 + list(range(10)),
        [1, 2],
    ):
        df = table(spark, values)
        every = spend_tiers(df, "spend", ["id"], 5).filter(F.col("spend_quartile") == tier)
        own = one_tier(df, "spend", ["id"], tier, 5)
        assert bag(own) == bag(every.drop("spend_quartile"))


def test_no_such_tier(spark):
    with pytest.raises(ValueError):
        one_tier(table(spark, [1]), "spend", ["id"], 5, 4)


def test_tile_ends_share_out_the_rest():
    assert [tile_ends(n, 4) for n in (0, 3, 4, 10)] == [
        [0, 0, 0, 0], [1, 2, 3, 3], [1, 2, 3, 4], [3, 6, 8, 10],
    ]


@pytest.mark.parametrize("descending", [True, False])
def test_cuts_at_positions(spark, descending):
    rng = random.Random(9)
    values = [rng.choice([None, 0, -3, 10**15, -(10**15), *range(5)]) for _ in range(60)]
    df = table(spark, values).cache()
    places = [1, 7, 8, 30, 59, 60]
    found = cuts_at(df, "spend", ["id"], lambda rows: [0, *places, rows + 1], descending)
    order = [F.col("spend").desc_nulls_first() if descending else F.col("spend").asc_nulls_last()]
    numbered = df.withColumn("n", F.row_number().over(Window.orderBy(*order, "id")))
    assert found.rows == 60 and [cut.position for cut in found.cuts] == places
    for cut in found.cuts:
        first = numbered.filter(until(cut, "spend", ["id"], descending))
        assert sorted(r.n for r in first.collect()) == list(range(1, cut.position + 1))


def test_ties_are_cut_by_several_columns(spark):
    rows = [(5, f"k{i % 3}", i) for i in range(30)]
    df = spark.createDataFrame(rows, "v bigint, a string, b bigint")
    (cut,) = cuts_at(df, "v", ["a", "b"], lambda n: [14]).cuts
    kept = df.filter(until(cut, "v", ["a", "b"])).collect()
    assert sorted((r.a, r.b) for r in kept) == sorted((a, b) for _, a, b in rows)[:14]
    assert cut.before == 0 and cut.equal == 30


def test_far_apart_decimals(spark):
    from decimal import Decimal

    values = [Decimal(f"{i}.0{i % 10}") * (10 ** (i % 16)) for i in range(1, 80)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v decimal(24,2)")
    cuts = cuts_at(df, "v", ["id"], lambda n: [1, 40, n]).cuts
    assert [cut.value for cut in cuts] == [sorted(values, reverse=True)[i] for i in (0, 39, -1)]
