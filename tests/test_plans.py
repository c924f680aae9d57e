from __future__ import annotations

import datetime
import re
from decimal import Decimal

import pytest
from parity import bag
from pyspark.sql import functions as F

from tillmark.operators import quality
from tillmark.plans import churn, cohort, rolling

D = datetime.date
CUSTOMERS = (
    "customer_id int, first_name string, last_name string, state string, "
    "loyalty_program string, signup_date date"
)
SALES = (
    "transaction_id bigint, customer_id int, store_id int, transaction_date date, "
    "amount decimal(10,2)"
)


def customers(spark, signups):
    rows = [(i, f"F{i}", f"L{i}", "NSW", "None", day) for i, day in signups.items()]
    return spark.createDataFrame(rows, CUSTOMERS)


def sales(spark, rows):
    numbered = [
        (n, customer, store, day, Decimal(amount))
        for n, (customer, store, day, amount) in enumerate(rows, start=1)
    ]
    return spark.createDataFrame(numbered, SALES)


AS_OF = "2024-12-31"


def days_ago(days):
    return D(2024, 12, 31) - datetime.timedelta(days=days)


def test_churn_day_boundaries(spark):
    people = customers(spark, {i: D(2024, 1, 1) for i in range(1, 17)})
    # Four big spenders make up the top quartile, twelve small ones the rest.
    big = [(i, 1, days_ago(d), 1000 + i) for i, d in zip(range(1, 5), (59, 60, 89, 90))]
    small = [(i, 1, days_ago(200), 1) for i in range(5, 17)]
    risk = churn.churn_risk(people, sales(spark, big + small), AS_OF).collect()
    assert [(r.customer_id, r.days_since_last_purchase, r.churn_risk_level) for r in risk] == [
        (4, 90, "Critical"),
        (3, 89, "High"),
        (2, 60, "High"),
    ]
    assert [r.spend_rank for r in risk] == [1, 2, 3]


def test_equal_customers_come_in_id_order(spark):
    people = customers(spark, {i: D(2024, 1, 1) for i in range(1, 41)})
    sold = sales(spark, [(i, 1, days_ago(100), 5) for i in range(40, 0, -1)])
    risk = churn.churn_risk(people, sold, AS_OF).collect()
    assert [r.customer_id for r in risk] == list(range(1, 11))
    assert {r.spend_rank for r in risk} == {1}


def test_churn_output_columns(spark):
    people = customers(spark, {1: D(2024, 1, 1)})
    risk = churn.churn_risk(people, sales(spark, [(1, 1, days_ago(70), "10.05")]), AS_OF)
    assert risk.columns == [
        "customer_id",
        "customer_name",
        "state",
        "loyalty_program",
        "total_transactions",
        "lifetime_spend",
        "avg_transaction_value",
        "last_transaction_date",
        "days_since_last_purchase",
        "spend_rank",
        "pct_of_total_revenue",
        "churn_risk_level",
    ]
    row = risk.first()
    assert row.customer_name == "F1 L1" and row.pct_of_total_revenue == Decimal("100.00")


def test_unknown_and_idle_customers_do_not_count(spark):
    people = customers(spark, {1: D(2024, 1, 1), 2: D(2024, 1, 1)})
    sold = sales(spark, [(1, 1, days_ago(5), 50), (99, 1, days_ago(5), 950)])
    scored = churn.scored_customers(people, sold, AS_OF).collect()
    assert [(r.customer_id, r.pct_of_total_revenue) for r in scored] == [(1, Decimal("100.00"))]
    assert churn.customer_activity(people, sold, AS_OF).count() == 1


def test_half_cent_average_goes_up(spark):
    people = customers(spark, {1: D(2024, 1, 1)})
    sold = sales(spark, [(1, 1, days_ago(5), "1.00"), (1, 1, days_ago(5), "1.01")])
    assert churn.customer_activity(people, sold, AS_OF).first().avg_transaction_value == Decimal(
        "1.01"
    )


def test_cohort_retention(spark):
    people = customers(
        spark,
        {1: D(2024, 1, 20), 2: D(2024, 1, 5), 3: D(2024, 1, 31), 4: D(2024, 3, 1)},
    )
    sold = sales(
        spark,
        [
            (1, 1, D(2024, 1, 2), 1),  # before signup, same month: month 0
            (1, 1, D(2023, 12, 30), 1),  # an earlier month: dropped
            (2, 1, D(2024, 3, 1), 1),
            (2, 1, D(2024, 3, 9), 1),  # same month again: one active customer
            (1, 1, D(2025, 1, 9), 1),
            (77, 1, D(2025, 1, 9), 1),  # unknown customer
        ],
    )
    got = [tuple(r) for r in cohort.cohort_retention(people, sold).collect()]
    assert got == [
        (D(2024, 1, 1), 3, 0, 1, Decimal("33.3")),
        (D(2024, 1, 1), 3, 2, 1, Decimal("33.3")),
        (D(2024, 1, 1), 3, 12, 1, Decimal("33.3")),
    ]  # customer 3 counts in the size; the March cohort has no activity and no row


def test_months_of_decades(spark):
    """Months beyond one word of bits, at the borders of words, and none at all."""
    first = D(1995, 3, 1)
    people = customers(spark, {1: D(1995, 3, 5), 2: D(2004, 1, 9), 3: D(1990, 1, 1)})
    days = [D(first.year + (2 + n) // 12, (2 + n) % 12 + 1, 3) for n in (0, 1, 63, 64, 127, 128, 240)]
    sold = sales(spark, [(c, 1, day, 1) for c in (1, 2, 3) for day in days] + [(3, 1, None, 1)])
    got = bag(cohort.cohort_retention(people, sold).select("cohort_month", "month_number"))
    wanted = [
        (start, (day.year - start.year) * 12 + day.month - start.month)
        for start in (D(1995, 3, 1), D(2004, 1, 1), D(1990, 1, 1))
        for day in days
        if day >= start
    ]
    assert got == sorted(wanted, key=repr)
    assert cohort.cohort_retention(people, sales(spark, [(1, 1, None, 1)])).count() == 0


def test_assign_cohorts_counts_idle_customers(spark):
    people = customers(spark, {1: D(2024, 1, 20), 2: D(2024, 1, 5), 3: D(2024, 2, 1)})
    assert bag(cohort.assign_cohorts(people)) == [
        (1, D(2024, 1, 1), 2),
        (2, D(2024, 1, 1), 2),
        (3, D(2024, 2, 1), 1),
    ]


def stores(spark, rows=((1, "NSW"), (2, "NSW"), (3, "VIC"))):
    return spark.createDataFrame(list(rows), "store_id int, state string")


def week(spark):
    return sales(
        spark,
        [
            (1, 1, D(2024, 5, 1), "10.00"),
            (1, 2, D(2024, 5, 1), "5.00"),
            (1, 1, D(2024, 5, 3), "30.00"),
            (1, 9, D(2024, 5, 4), "99.00"),  # unknown store: only stretches the calendar
        ],
    )


def test_rolling_fills_gaps_and_silent_states(spark):
    got = {
        (r.state, r.transaction_date.day): r
        for r in rolling.rolling_revenue(week(spark), stores(spark)).collect()
    }
    assert len(got) == 8  # two states, 1-4 May
    gap = got["NSW", 2]
    assert (gap.daily_revenue, gap.daily_transactions, gap.daily_avg_basket) == (0, 0, 0)
    assert got["NSW", 1].daily_avg_basket == Decimal("7.50")
    assert got["NSW", 3].revenue_last_7_days == Decimal("45.00")
    # (7.5 + 0 + 30) / 3: a partial frame, days without sales count as 0
    assert got["NSW", 3].avg_basket_last_30_days == Decimal("12.50")
    assert got["NSW", 1].day_over_day_pct_change is None  # first day
    assert got["NSW", 2].day_over_day_pct_change == Decimal("-100.0")
    assert got["NSW", 3].day_over_day_pct_change is None  # the day before had none
    assert all(got["VIC", day].revenue_last_30_days == 0 for day in range(1, 5))


def test_many_stores_give_the_same(spark, small_limits):
    few = bag(rolling.rolling_revenue(week(spark), stores(spark)))
    assert len(few) == 8
    assert sum(row[2] for row in few) == Decimal("45.00")


def test_rolling_equals_the_literal_fan_out(spark, partitions):
    rows = [
        (i % 5, i % 4 + 1, D(2024, 1, 1) + datetime.timedelta(days=i * i % 50), i + 1)
        for i in range(200)
    ]
    sold = sales(spark, rows)
    shops = stores(spark, [(1, "NSW"), (2, "VIC"), (3, "NSW"), (4, "QLD"), (5, "WA")])
    ours = rolling.daily_sales(sold, shops).select(
        "state", "transaction_date", "daily_revenue", "daily_transactions"
    )
    spine = rolling.sales_calendar(sold, shops)
    literal = (
        spine.join(shops, "state", "left")
        .join(sold, ["store_id", "transaction_date"], "left")
        .groupBy("state", "transaction_date")
        .agg(F.coalesce(F.sum("amount"), F.lit(0)), F.count("transaction_id"))
    )
    assert bag(ours) == bag(literal)


def test_empty_sales(spark):
    empty = sales(spark, [(1, 1, D(2024, 1, 1), 1)]).filter("false")
    people = customers(spark, {1: D(2024, 1, 1)})
    assert rolling.rolling_revenue(empty, stores(spark)).count() == 0
    assert churn.churn_risk(people, empty, AS_OF).count() == 0
    assert cohort.cohort_retention(people, empty).count() == 0


@pytest.mark.parametrize("days", [30, 45])
def test_long_frames_are_complete(spark, days):
    sold = sales(
        spark, [(1, 3, D(2024, 1, 1) + datetime.timedelta(days=i), 2) for i in range(days)]
    )
    last = (
        rolling.rolling_revenue(sold, stores(spark))
        .filter("state = 'VIC'")
        .orderBy(F.desc("transaction_date"))
        .first()
    )
    assert last.revenue_last_7_days == 14 and last.revenue_last_30_days == 60


def test_basket_mean_of_inexact_daily_means(spark):
    """Daily means of a third of a cent, whose 30-day mean is exactly half a cent."""
    rows = []
    for i in range(3):
        day = D(2024, 1, 1) + datetime.timedelta(days=i)
        rows += [(1, 3, day, "0.01"), (1, 3, day, "0.00"), (1, 3, day, "0.00")]
    rows.append((1, 3, D(2024, 1, 4), "0.01"))
    last = (
        rolling.rolling_revenue(sales(spark, rows), stores(spark))
        .filter("state = 'VIC' AND transaction_date = '2024-01-04'")
        .first()
    )
    # 3 x 0.00333333333333 + 0.01 falls short of 0.02, by less than 14 places show
    assert last.avg_basket_last_30_days == Decimal("0.01")


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """Tables on disk, so that plans show their scans."""
    people = customers(spark, {i: D(2024, 1, 1 + i) for i in range(1, 9)})
    sold = sales(
        spark,
        [(i % 8 + 1, i % 3 + 1, D(2024, 2, 1) + datetime.timedelta(days=i), i) for i in range(1, 60)],
    )
    frames = {"people": people, "sold": sold, "shops": stores(spark)}
    for name, frame in frames.items():
        frame.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in frames}


def test_transactions_are_not_scanned_again(stored):
    """Ranked and daily tables are read from their written copy."""
    scan = re.compile(r"ReadSchema: struct<[^>]*amount")
    assert scan.search(executed(churn.purchase_totals(stored["sold"])))
    for plan in (
        executed(churn.churn_risk(stored["people"], stored["sold"], AS_OF)),
        executed(rolling.rolling_revenue(stored["sold"], stored["shops"])),
    ):
        assert not scan.search(plan)


def test_scans_read_only_needed_columns(stored):
    totals = executed(churn.purchase_totals(stored["sold"]))
    assert "store_id" not in totals.split("ReadSchema")[1]
    months = executed(cohort.monthly_activity(stored["sold"]))
    assert months.split("ReadSchema: struct<")[1].startswith("customer_id:int,transaction_date")


def test_sums_are_partial_before_the_shuffle(stored):
    # Sales go to (store, day), then those sums to (state, day).
    for plan, shuffles in (
        (executed(churn.purchase_totals(stored["sold"])), 1),
        (executed(rolling.sales_by_state_day(stored["sold"], stored["shops"])), 2),
    ):
        assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")
        assert plan.rindex("partial_sum") > plan.rindex("Exchange hashpartitioning")
        assert plan.count("Exchange hashpartitioning") == shuffles


def test_one_shuffle_of_the_sales_for_cohorts_and_dates(stored, small_limits):
    retention = executed(cohort.cohort_retention(stored["people"], stored["sold"]))
    assert retention.count("Exchange hashpartitioning(customer_id") == 2  # sales and customers
    order = quality.check_date_order(
        stored["sold"], "t", "customer_id", "transaction_date",
        stored["people"], "customer_id", "signup_date",
    )
    assert executed(order).count("Exchange hashpartitioning(customer_id") == 2


def test_suite_reads_the_columns_of_the_sales_once(stored, small_limits):
    frames = {
        "transactions": stored["sold"].withColumns(
            {"product_id": F.lit(1), "unit_price": F.col("amount"), "quantity": F.lit(1)}
        ),
        "customers": stored["people"].withColumn("email", F.col("last_name")),
        "stores": stored["shops"],
        "products": stored["shops"].select(F.col("store_id").alias("product_id")),
    }
    plan = executed(quality.integrity_suite(frames, AS_OF))
    # Scans are told apart by their columns: Spark shortens long paths in plans.
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    for column, readers in {"transaction_date": 1, "amount": 1, "customer_id": 2}.items():
        assert sum(f"{column}#" in scan for scan in scans) == readers


def test_rolling_revenue_is_ordered(stored):
    rows = rolling.rolling_revenue(stored["sold"], stored["shops"]).collect()
    places = [(r["state"], r["transaction_date"]) for r in rows]
    assert places == sorted(places)


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_daily_types_do_not_depend_on_the_stores(spark, stored, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    kinds = dict(rolling.daily_sales(stored["sold"], stored["shops"]).dtypes)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    money = dict(stored["sold"].agg(F.sum("amount").alias("s")).dtypes)["s"]
    assert kinds["daily_revenue"] == money


def test_totals_agree(stored):
    whole = stored["sold"].agg(F.sum("amount")).first()[0]
    daily = rolling.daily_sales(stored["sold"], stored["shops"])
    assert daily.agg(F.sum("daily_revenue")).first()[0] == whole
    assert daily.count() == 2 * 59  # states x days
    scored = churn.scored_customers(stored["people"], stored["sold"], AS_OF)
    assert abs(scored.agg(F.sum("pct_of_total_revenue")).first()[0] - 100) < Decimal("0.05")
    retention = cohort.cohort_retention(stored["people"], stored["sold"])
    assert retention.filter("retention_pct > 100").count() == 0
