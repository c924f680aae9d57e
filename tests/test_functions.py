from __future__ import annotations

import datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillmark.functions import dates, draws, money, text


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def dec(number, precision=28, scale=2):
    return F.lit(Decimal(str(number))).cast(f"decimal({precision},{scale})")


@pytest.mark.parametrize(
    ("top", "bottom", "places", "expected"),
    [
        ("0.05", 10, 2, "0.01"),  # half a cent goes up
        ("-0.05", 10, 2, "-0.01"),  # and away from zero
        ("1", 3, 4, "0.3333"),
        ("2", 3, 4, "0.6667"),
        ("1", -8, 2, "-0.13"),
        ("0", 5, 2, "0.00"),
        ("10049.999925", 10000, 2, "1.00"),  # 1.0049999925: no double rounding
    ],
)
def test_round_ratio_is_half_away_from_zero(spark, top, bottom, places, expected):
    ratio = money.round_ratio(dec(top, 28, 6), F.lit(bottom), places)
    assert value(spark, ratio) == Decimal(expected)


def test_round_ratio_of_zero_is_null(spark):
    assert value(spark, money.round_ratio(dec(1), dec(0), 2)) is None
    assert value(spark, money.mean(dec(1), F.lit(0))) is None


@settings(max_examples=25, deadline=None)
@given(
    pairs=st.lists(
        st.tuples(st.integers(-(10**12), 10**12), st.integers(1, 10**6)), min_size=1, max_size=20
    )
)
def test_round_ratio_against_fractions(spark, pairs):
    rows = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = rows.select("a", "b", money.round_ratio(F.col("a"), F.col("b"), 2).alias("r")).collect()
    for row in got:
        exact = abs(Fraction(row.a, row.b)) * 100
        units = int(exact + Fraction(1, 2)) * (-1 if row.a < 0 else 1)
        assert row.r == Decimal(units).scaleb(-2)


def test_dates(spark):
    day = F.lit("2024-02-29").cast("date")
    later = F.lit("2025-01-01").cast("date")
    assert value(spark, dates.month_start(day)) == datetime.date(2024, 2, 1)
    assert value(spark, dates.month_number(day, later)) == 11
    assert value(spark, dates.days_between(day, later)) == 307
    assert value(spark, dates.from_iso(dates.iso_text(day))) == datetime.date(2024, 2, 29)
    assert value(spark, dates.as_of_date(None)) == value(spark, F.current_date())


def test_date_in_range_includes_both_ends_and_spans_a_day_at_least(spark):
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date")
    rows = spark.range(9).select(
        dates.date_in_range(first, last, F.col("id")).alias("d"),
        dates.date_in_range(last, first, F.col("id")).alias("e"),
    )
    assert {row.d.day for row in rows.collect()} == {1, 2, 3}
    assert {row.e.day for row in rows.collect()} == {3, 4}


def test_draws_depend_on_seed_stream_and_key_only(spark):
    rows = spark.range(500)
    drawn = draws.draw(1, "a", F.col("id")).alias("d")
    once = {r.id: r.d for r in rows.select("id", drawn).collect()}
    again = {r.id: r.d for r in rows.repartition(7).select("id", drawn).collect()}
    assert once == again
    assert all(0 <= d < draws.DRAW_SPACE for d in once.values())
    other = {r.id: r.d for r in rows.select("id", draws.draw(2, "a", F.col("id")).alias("d")).collect()}
    assert once != other


def test_weighted_choice_boundaries(spark):
    bounds = draws.thresholds(["0.5", "0.3", "0.2"])
    assert bounds[-1] == draws.DRAW_SPACE
    points = [0, bounds[0] - 1, bounds[0], bounds[1] - 1, bounds[1], draws.DRAW_SPACE - 1]
    rows = spark.createDataFrame([(p,) for p in points], "d bigint")
    picked = rows.select(draws.weighted_choice(F.col("d"), list("abc"), ["0.5", "0.3", "0.2"]))
    assert [row[0] for row in picked.collect()] == list("aabbcc")


def test_weighted_choice_shares(spark):
    rows = spark.range(20000).withColumn("d", draws.draw(3, "s", F.col("id")))
    counts = (
        rows.groupBy(draws.weighted_choice(F.col("d"), ["x", "y"], ["0.9", "0.1"]).alias("v"))
        .count()
        .collect()
    )
    share = {row.v: row["count"] / 20000 for row in counts}
    assert abs(share["x"] - 0.9) < 0.01


def test_weighted_choice_rejects_bad_lists():
    with pytest.raises(ValueError):
        draws.weighted_choice(None, ["a"], [])


def test_pick_in_ranges(spark):
    picked = draws.pick_in_ranges(F.col("id") % 2, F.col("id"), [(10, 12), (20, 20)])
    values = {row[0] for row in spark.range(20).select(picked).collect()}
    assert values == {10, 11, 12, 20}


def test_contact_text(spark):
    first, last, none = F.lit("Ann"), F.lit("Lee"), F.lit(None).cast("int")
    assert value(spark, text.email_address(first, last, F.lit(7), "x.au")) == "ann.lee7@x.au"
    assert value(spark, text.mobile_number(F.lit(3), F.lit(4), F.lit(56))) == "0403 004 056"
    assert value(spark, text.mobile_number(F.lit(3), none, F.lit(56))) is None
    assert value(spark, text.region_type(F.lit("Sydney CBD"), F.lit(False))) == "Metro"
    assert value(spark, text.region_type(F.lit("Logan"), F.lit(False))) == "Regional"


def test_text(spark):
    first, last = F.lit("Ann"), F.lit("Lee")
    assert value(spark, text.full_name(first, last)) == "Ann Lee"
    assert value(spark, text.full_name(first, F.lit(None).cast("string"))) is None
    assert value(spark, text.initials(first, F.lit("o'Lee"))) == "AO"
    assert value(spark, text.after(F.lit("a@b@x.au"), "@")) == "x.au"
    assert value(spark, text.after(F.lit("none"), "@")) == "none"
    assert value(spark, text.padded(F.lit(42), 4)) == "0042"
    assert value(spark, text.map_value(F.lit("b"), {"a": 1}, 0)) == 0
    assert value(spark, text.map_value(F.lit("a"), {"a": 1})) == 1


def test_price_line(spark):
    total = money.line_total(F.lit(3), dec("3.35", 8))
    assert value(spark, total) == Decimal("10.05")
    assert value(spark, money.discount_amount(total, dec("0.10", 4))) == Decimal("1.01")


def test_ratios_beyond_18_digits_raise(spark):
    frame = spark.createDataFrame([(10**15, Decimal("0.01"))], "a bigint, b decimal(4,2)")
    with pytest.raises(Exception, match="more than 18 digits"):
        frame.select(money.percent(F.col("a").cast("decimal(18,2)"), F.col("b"), 2)).collect()
