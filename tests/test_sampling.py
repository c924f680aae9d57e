from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest
from parity import bag
from pyspark.sql import functions as F

from tillmark.functions.draws import DRAW_SPACE, draw
from tillmark.operators import sampling as s
from tillmark.operators.lookup import hot_keys, lookup, lookup_skewed


def wanted(spark, n, *streams):
    rows = spark.range(n).withColumnRenamed("id", "draw_id")
    return rows.withColumns({name: draw(9, name, F.col("draw_id")) for name in streams})


@pytest.fixture
def weights(spark):
    rows = [(i, Decimal(w)) for i, w in enumerate(["0.5", "0", "2.25", "1", "0.25"] * 8)]
    return spark.createDataFrame(rows, "item int, weight decimal(6,2)")


def exact_sample(draws, weights):
    """Brute force over exact integers."""
    line, total = [], 0
    for row in sorted(weights.collect()):
        total += int(row.weight * 100)
        line.append((total, row.item))
    picked = []
    for row in draws.collect():
        at = row.d * total // DRAW_SPACE
        picked.append((row.draw_id, next(item for end, item in line if at < end)))
    return sorted(picked)


def test_weighted_sample_against_brute_force(spark, weights, partitions):
    draws = wanted(spark, 600, "d")
    got = s.weighted_sample(draws, "d", ["draw_id"], weights, "item", "weight")
    assert sorted((r.draw_id, r.item) for r in got.collect()) == exact_sample(draws, weights)


def test_item_with_most_of_the_weight(spark):
    table = spark.range(50).select(
        F.col("id").alias("item"), F.when(F.col("id") == 7, 5000).otherwise(1).alias("weight")
    )
    draws = wanted(spark, 3000, "d")
    got = s.weighted_sample(draws, "d", ["draw_id"], table, "item", "weight")
    counts = Counter(r.item for r in got.collect())
    assert sum(counts.values()) == 3000 and counts[7] > 2900


def test_float_weights_are_refused(spark):
    table = spark.range(3).withColumn("weight", F.lit(0.5))
    with pytest.raises(TypeError):
        s.weighted_sample(wanted(spark, 3, "d"), "d", ["draw_id"], table, "id", "weight")


def members(spark):
    rows = [("A", 10), ("A", 11), ("A", 12), ("B", 20), ("C", 30), ("C", 31)]
    return spark.createDataFrame(rows, "grp string, member int")


def test_member_index(spark, partitions):
    got = s.member_index(members(spark), "grp", "member")
    assert bag(got.select("grp", "member", "member_index", "position")) == [
        ("A", 10, 1, 1),
        ("A", 11, 2, 2),
        ("A", 12, 3, 3),
        ("B", 20, 1, 4),
        ("C", 30, 1, 5),
        ("C", 31, 2, 6),
    ]


def grouped_draws(spark, n=900):
    groups = F.when(F.col("draw_id") % 3 == 0, "A").when(F.col("draw_id") % 3 == 1, "B")
    return wanted(spark, n, "chance", "d").withColumn("grp", groups.otherwise("Z"))


def picks(spark):
    return bag(s.uniform_pick(grouped_draws(spark), "d", "grp", members(spark), "member"))


def test_uniform_pick_stays_in_the_group(spark):
    rows = picks(spark)
    assert len(rows) == 600  # group Z has no members
    inside = {"A": {10, 11, 12}, "B": {20}}
    assert all(row[-1] in inside[row[-2]] for row in rows)
    shares = Counter(row[-1] for row in rows if row[-2] == "A")
    assert min(shares.values()) > 70


def test_large_dimensions_give_the_same_picks(spark, small_limits):
    forced = picks(spark)
    assert len(forced) == 600


def test_affinity(spark):
    rows = s.affinity_assign(grouped_draws(spark), "chance", "d", "grp", members(spark), "member")
    got = rows.collect()
    assert len(got) == 900
    own = Counter(row.grp for row in got if row.grp == "B" and row.member == 20)
    assert own["B"] / 300 > 0.85
    assert len({row.member for row in got if row.grp == "Z"}) == 6  # no members: all of them


def test_two_stage_pick(spark):
    draws = wanted(spark, 2000, "g", "m")
    got = s.two_stage_pick(draws, "g", "m", ["draw_id"], members(spark), "grp", "member", {"B": 8})
    counts = Counter(row.grp for row in got.collect())
    assert sum(counts.values()) == 2000
    assert abs(counts["B"] / 2000 - 0.8) < 0.04  # A and C weigh 1 each


def test_next_keys_continue(spark):
    new = spark.createDataFrame([("x",), ("y",), ("z",)], "name string")
    old = spark.createDataFrame([(4,), (9,)], "id int")
    got = s.next_keys(new, [F.col("name")], old, "id")
    assert bag(got.select("name", "id")) == [("x", 10), ("y", 11), ("z", 12)]
    first = s.next_keys(new, [F.col("name")], old.filter("false"), "id")
    assert min(r.id for r in first.collect()) == 2


def test_normalised_weights_sum_to_one(spark, weights):
    shares = s.normalise_weights(weights, "weight", "share")
    assert abs(shares.agg(F.sum("share")).first()[0] - 1) < 1e-12


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_of_a_hot_key(spark, how, small_limits):
    """Most rows are identical and have one key; nothing is broadcast."""
    key = F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id"))
    facts = spark.range(1000).select(key.alias("k"), F.when(key == 1, 0).otherwise(key).alias("f"))
    dimension = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    own = {row.k: row.v for row in dimension.collect()}
    rows = [tuple(row) for row in facts.collect()]
    if how == "left_semi":
        wanted = [row for row in rows if row[0] in own]
    else:
        wanted = [(*row, own.get(row[0])) for row in rows if how == "left" or row[0] in own]
    assert bag(lookup(facts, dimension, ["k"], how)) == sorted(wanted, key=repr)


def test_lookup_keeps_facts_only():
    with pytest.raises(ValueError):
        lookup(None, None, ["k"], "right")


@pytest.mark.parametrize("bad", [-5, None])
def test_weights_below_zero_or_null_raise(spark, bad):
    table = spark.createDataFrame([(1, 2), (2, bad), (3, 0)], "item bigint, weight int")
    draws = spark.range(5).selectExpr("id AS draw_id", "id AS d")
    with pytest.raises(ValueError, match="below 0 or NULL"):
        s.weighted_sample(draws, "d", ["draw_id"], table, "item", "weight")


@pytest.mark.parametrize("items", [3, 300])
def test_the_item_keeps_its_type(spark, items):
    table = spark.range(items).selectExpr("id AS item", "1 AS weight")
    draws = spark.range(5).selectExpr("id AS draw_id", "id AS d")
    got = s.weighted_sample(draws, "d", ["draw_id"], table, "item", "weight")
    assert got.schema["item"].dataType.simpleString() == "bigint" and got.count() == 5


def test_hot_keys_are_all_found(spark):
    facts = spark.range(20000).select(
        F.when(F.col("id") % 10 < 4, F.lit("a"))
        .when(F.col("id") % 10 < 6, F.lit(None))
        .otherwise(F.col("id").cast("string"))
        .alias("k")
    )
    hot = hot_keys(facts, ["k"], 0.1)
    wanted = facts.select(F.xxhash64("k").alias("h"), "k").filter("k = 'a' OR k IS NULL").distinct()
    assert sorted(hot) == sorted(r.h for r in wanted.collect())
    assert hot_keys(facts.filter("false"), ["k"], 0.1) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skewed_lookup_equals_a_plain_one(spark, how, monkeypatch):
    facts = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 10 < 7, 5).when(F.col("id") % 10 == 7, None)
        .otherwise(F.col("id") % 400).cast("int").alias("k"),
    )
    sizes = spark.range(300).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    plain = bag(lookup(facts, sizes, ["k"], how))
    assert bag(lookup_skewed(facts, sizes, ["k"], how)) == plain
    monkeypatch.setattr("tillmark.operators.lookup.HOT_BYTES", 1)
    assert bag(lookup_skewed(facts, sizes, ["k"], how)) == plain


def test_hot_key_does_not_fill_one_task(spark, small_limits):
    """70 % of the rows on one key, without adaptive execution."""
    facts = spark.range(0, 40000, 1, 8).select(
        "id", F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id")).alias("k")
    )
    sizes = spark.range(0, 40000, 1, 4).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def tasks(df):
            held = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
            return sorted(r["count"] for r in held)

        spread = tasks(lookup_skewed(facts, sizes, ["k"]))
        assert max(spread) <= 3 * spread[len(spread) // 2]
        assert max(tasks(lookup(facts, sizes, ["k"]))) > 20000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
