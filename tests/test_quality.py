from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from parity import bag
from pyspark.sql import functions as F

from tillmark.operators import quality as q
from tillmark.operators.incremental import incremental_report

D = datetime.date


def violations(report):
    return {r.column: r.violations for r in report.collect()}


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [
            (1, 10, D(2024, 1, 1), 1, Decimal("5.00"), Decimal("0.00"), Decimal("5.00")),
            (2, None, D(2024, 1, 5), 2, Decimal("5.00"), Decimal("1.00"), Decimal("10.01")),
            (2, 99, D(2024, 2, 1), 0, Decimal("0.00"), Decimal("-1.00"), Decimal("0.02")),
            (4, 99, None, 3, None, None, None),
        ],
        "id int, customer_id int, day date, quantity int, unit_price decimal(8,2), "
        "discount_amount decimal(8,2), amount decimal(10,2)",
    )


def test_row_checks(sales):
    checks = (
        q.not_null("customer_id", "amount")
        + q.positive("quantity", "unit_price")
        + q.not_negative("discount_amount")
        + [q.not_future("day", "2024-01-31")]
    )
    got = violations(q.check_rows(sales, "sales", checks))
    assert got == {
        "customer_id": 1,
        "amount": 1,
        "quantity": 1,
        "unit_price": 1,
        "discount_amount": 1,
        "day": 1,
    }


def test_line_total_tolerates_one_cent(sales):
    report = q.check_rows(sales, "sales", [q.within_line_total()]).first()
    assert (report.rows_checked, report.violations, report.passed) == (4, 1, False)


def test_violating_rows_name_their_checks(sales):
    bad = q.violating_rows(sales, [q.within_line_total(), *q.positive("quantity")])
    assert [r.broken_checks for r in bad.collect()] == [
        ["within_line_total(amount)", "positive(quantity)"]
    ]


def test_references_count_null_keys(spark, sales):
    people = spark.createDataFrame([(10,), (11,)], "id int")
    assert q.check_references(sales, "s", "customer_id", people, "id").first().violations == 3
    assert bag(q.orphan_keys(sales, "customer_id", people, "id")) == [(99, 2), (None, 1)]
    assert q.orphan_rows(sales, "customer_id", people, "id").count() == 3
    known = spark.createDataFrame([(10,), (99,)], "id int")
    assert q.check_references(sales, "s", "customer_id", known, "id").first().violations == 1


def test_unique_counts_nulls_and_repeats(spark):
    people = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "email string")
    report = q.check_unique(people, "people", ["email"]).first()
    assert (report.rows_checked, report.violations, report.passed) == (4, 2, False)
    assert bag(q.duplicate_keys(people, ["email"])) == [("a", 2)]
    assert q.check_unique(people.filter("email = 'b'"), "people", ["email"]).first().passed


def test_date_order(spark, sales):
    people = spark.createDataFrame(
        [(10, D(2024, 1, 2)), (99, D(2024, 1, 1))], "id int, signup date"
    )
    report = q.check_date_order(sales, "s", "customer_id", "day", people, "id", "signup").first()
    assert (report.rows_checked, report.violations) == (3, 1)


def test_domain_passes_on_null(spark):
    df = spark.createDataFrame([("NSW",), ("XX",), ("XX",), (None,)], "state string")
    check = q.in_domain("state", ["NSW", "VIC"])
    assert q.check_rows(df, "t", [check]).first().violations == 2
    assert bag(q.unexpected_values(df, "state", ["NSW", "VIC"])) == [("XX", 2)]


def test_conditional_domain(spark):
    df = spark.createDataFrame(
        [("a", "A"), ("a", "B"), ("b", "B"), ("z", "A")], "banner string, parent string"
    )
    check = q.matches_group("banner", "parent", {"A": ["a"], "B": ["b"]})
    assert q.check_rows(df, "t", [check]).first().violations == 2


def test_length_and_numeric_range(spark):
    df = spark.createDataFrame(
        [("abc", 999.994, "1.5"), ("abcd", 999.995, "x"), (None, None, None)],
        "t string, n double, s string",
    )
    checks = [q.max_length("t", 3), q.fits_numeric("n", 5, 2), q.fits_numeric("s", 5, 2, True)]
    assert violations(q.check_rows(df, "t", checks)) == {"t": 1, "n": 1, "s": 1}


@pytest.mark.parametrize(("minimum", "missing"), [(1, 0), (4, 0), (10, 6)])
def test_volume(sales, minimum, missing):
    report = q.check_volume(sales, "sales", minimum).first()
    assert (report.violations, report.passed) == (missing, missing == 0)


def test_empty_tables(spark, sales):
    none = sales.filter("false")
    people = spark.createDataFrame([(10, D(2024, 1, 2))], "id int, signup date")
    reports = q.all_reports(
        [
            q.check_volume(none, "s"),
            q.check_unique(none, "s", ["id"]),
            q.check_references(none, "s", "customer_id", people, "id"),
            q.check_date_order(none, "s", "customer_id", "day", people, "id", "signup"),
        ]
    )
    assert [(r.violations, r.passed) for r in reports.collect()] == [
        (1, False),
        (0, True),
        (0, True),
        (0, True),
    ]
    assert len(q.failures(reports)) == 1


def test_row_checks_scan_once(spark, tmp_path, sales):
    sales.write.parquet(str(tmp_path / "sales"))
    stored = spark.read.parquet(str(tmp_path / "sales"))
    checks = q.positive("quantity", "unit_price", "amount") + q.not_null("id", "day")
    plan = q.check_rows(stored, "s", checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "customer_id" not in plan.split("ReadSchema")[1]


def test_suite_covers_the_standing_cases(spark, sales):
    people = spark.createDataFrame(
        [(10, "a@x", "NSW", D(2024, 1, 1)), (99, "b@x", "XX", D(2024, 1, 1))],
        "customer_id int, email string, state string, signup_date date",
    )
    frames = {
        "customers": people,
        "stores": spark.createDataFrame([(1,)], "store_id int"),
        "products": spark.createDataFrame([(1,)], "product_id int"),
        "transactions": sales.withColumns({"store_id": F.lit(1), "product_id": F.lit(2)})
        .withColumnRenamed("day", "transaction_date"),
    }
    report = q.integrity_suite(frames, "2024-01-31", minimum_transactions=4)
    got = {(r.table, r.check, r.column): r.violations for r in report.collect()}
    assert len(got) == 20  # transactions: being populated and large enough is one check
    assert got["customers", "in_domain", "state"] == 1
    assert got["transactions", "references", "product_id"] == 4
    assert got["transactions", "not_future", "transaction_date"] == 1
    assert got["transactions", "volume", "*"] == 0


def test_only_new_files_are_read(spark, tmp_path):
    folder, state = str(tmp_path / "sales"), str(tmp_path / "state")
    checks = [*q.positive("amount"), *q.not_null("day"), q.not_before("day", "start")]
    frame = spark.range(100).select(
        (F.col("id") - 3).alias("amount"),
        F.when(F.col("id") % 10 > 0, F.lit("2024-02-02").cast("date")).alias("day"),
        F.lit("2024-02-03").cast("date").alias("start"),
        (F.col("id") % 2).alias("half"),
    )

    def run(rules=checks):
        report, read = incremental_report(spark, folder, state, "sales", rules, 150)
        whole = q.check_rows(spark.read.parquet(folder), "sales", rules, 150)
        assert bag(report) == bag(whole)
        assert dict(report.dtypes) == dict(whole.dtypes)
        return read

    frame.coalesce(1).write.partitionBy("half").parquet(folder)
    assert len(run()) == 2 and run() == []
    frame.limit(7).coalesce(1).write.mode("append").parquet(f"{folder}/half=1")
    assert len(run()) == 1 and run() == []
    assert len(run(checks[:2])) == 3  # other rules know no file yet
    (gone, *_) = (tmp_path / "sales" / "half=0").glob("*.parquet")
    gone.unlink()
    assert run() == []


def test_empty_folder_breaks_the_volume_only(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none"))
    report, _ = incremental_report(
        spark, str(tmp_path / "none"), str(tmp_path / "state"), "t", q.positive("id"), 2
    )
    got = {r.check: (r.rows_checked, r.violations, r.passed) for r in report.collect()}
    assert got == {"volume": (0, 2, False), "positive": (0, 0, True)}
