from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from parity import bag
from pyspark.sql import functions as F

from tillmark.operators.quality import check_date_order, check_tables, failures
from tillmark.plans import churn, cohort
from tillmark.sources import contracts, tables

D = datetime.date


@pytest.fixture
def frames(spark):
    customers = spark.createDataFrame(
        [
            (1, "Ann", "Lee", "ann@x.au", "NSW", "2000", "2024-01-01"),
            (2, "Bob", "May", "bob@x.au", "VIC", "3000", "2024-02-01"),
        ],
        "customer_id int, first_name string, last_name string, email string, state string, "
        "postcode string, signup_date string",
    )
    stores = spark.createDataFrame(
        [(1, "Coles Glenelg", "Coles", "Coles Group", "Glenelg", "SA", "5045", "2010-05-05")],
        "store_id int, store_name string, banner string, parent_group string, suburb string, "
        "state string, postcode string, opened_date string",
    )
    products = tables.literal_table(
        spark,
        [("Bread", "Bakery", "Own", "each", 4.2), ("Milk", "Dairy & Eggs", "Own", "each", 3.6)],
        contracts.PRODUCTS,
    )
    transactions = spark.createDataFrame(
        [
            (1, 1, 1, 1, "2024-03-01", 2, 4.2, 8.4, "Cash"),
            (2, 2, 1, 2, "2024-03-02", 1, 3.6, 3.6, "EFTPOS"),
        ],
        "transaction_id bigint, customer_id int, store_id int, product_id int, "
        "transaction_date string, quantity int, unit_price double, amount double, "
        "payment_method string",
    )
    return {
        "transactions": transactions,
        "customers": customers,
        "stores": stores,
        "products": products,
    }


def test_defaults_and_types(frames):
    customers = tables.conform(frames["customers"], contracts.CUSTOMERS)
    row = customers.first()
    assert row.loyalty_program == "None" and row.phone is None
    assert row.created_at is not None and row.signup_date == D(2024, 1, 1)
    sold = tables.conform(frames["transactions"], contracts.TRANSACTIONS).first()
    assert (sold.discount_amount, sold.amount) == (Decimal("0.00"), Decimal("8.40"))


def test_schema_of_a_contract():
    schema = contracts.TRANSACTIONS.schema()
    assert schema["amount"].dataType.simpleString() == "decimal(10,2)"
    assert contracts.CUSTOMERS.schema()["phone"].nullable
    assert not contracts.CUSTOMERS.schema()["email"].nullable


def test_missing_required_column(frames):
    with pytest.raises(ValueError, match="email"):
        tables.conform(frames["customers"].drop("email"), contracts.CUSTOMERS)


def test_literal_table_is_numbered_from_one(frames):
    assert [r.product_id for r in frames["products"].orderBy("product_id").collect()] == [1, 2]
    assert frames["products"].first().unit_price == Decimal("4.20")


@pytest.mark.parametrize("place", ["folder", "catalog"])
def test_load_append_and_refresh(spark, frames, tmp_path, place):
    location = str(tmp_path / "data")
    if place == "catalog":
        spark.sql("CREATE DATABASE IF NOT EXISTS loading")
        location = "catalog:loading"
    tables.load_tables(frames, location, as_of="2024-12-31")
    back = tables.read_tables(spark, location)
    written = tables.conform(frames["transactions"], contracts.TRANSACTIONS)
    assert bag(back["transactions"]) == bag(written)
    assert tables.has_rows(back["customers"])

    with pytest.raises(tables.FailedChecks, match="stores.store_id: new_key"):
        tables.load_tables({"stores": frames["stores"]}, location)
    second = frames["stores"].withColumn("store_id", F.lit(2))
    tables.load_tables({"stores": second}, location)
    assert tables.read_table(spark, contracts.STORES, location).count() == 2
    tables.load_tables(frames, location, mode="overwrite", as_of="2024-12-31")
    assert tables.read_table(spark, contracts.STORES, location).count() == 1


@pytest.mark.parametrize("place", ["folder", "catalog"])
@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_failure_between_tables_leaves_the_old_state(spark, frames, tmp_path, place, mode):
    location = str(tmp_path / "data")
    if place == "catalog":
        spark.sql(f"CREATE DATABASE IF NOT EXISTS failing_{mode}")
        location = f"catalog:failing_{mode}"
    tables.load_tables(frames, location, as_of="2024-12-31")
    before = {name: bag(frame) for name, frame in tables.read_tables(spark, location).items()}
    reading = tables.read_table(spark, contracts.STORES, location)
    fails = F.when(F.col("transaction_id") == 2, F.raise_error(F.lit("planted")).cast("int"))
    broken = {
        "stores": frames["stores"].withColumn("store_id", F.lit(2)),
        "transactions": frames["transactions"].withColumn("quantity", fails.otherwise(F.lit(1))),
    }
    with pytest.raises(Exception, match="planted"):
        tables.load_tables(broken, location, mode=mode, checked=False)
    after = tables.read_tables(spark, location)
    assert {name: bag(frame) for name, frame in after.items()} == before
    whole = {**frames, "stores": frames["stores"].withColumn("store_id", F.lit(2))}
    whole["transactions"] = frames["transactions"].withColumn("store_id", F.lit(2))
    tables.load_tables(whole, location, mode="overwrite", as_of="2024-12-31")
    assert tables.read_table(spark, contracts.STORES, location).first().store_id == 2
    assert reading.first().store_id == 1  # a refresh deletes nothing under a reader


def test_append_to_a_plain_folder(spark, frames, tmp_path):
    location = str(tmp_path / "data")
    for name, frame in frames.items():
        tables.conform(frame, contracts.TABLES[name]).write.parquet(f"{location}/{name}")
    for store in (2, 3):
        tables.load_tables({"stores": frames["stores"].withColumn("store_id", F.lit(store))}, location)
    stores = tables.read_table(spark, contracts.STORES, location)
    assert sorted(r.store_id for r in stores.collect()) == [1, 2, 3]
    assert tables.read_table(spark, contracts.CUSTOMERS, location).count() == 2
    tables.load_tables({}, location)


def test_load_refuses_broken_tables(spark, frames, tmp_path):
    location = str(tmp_path / "data")
    broken = {**frames, "customers": frames["customers"].filter("customer_id = 1")}
    with pytest.raises(tables.FailedChecks, match="transactions.customer_id: references"):
        tables.load_tables(broken, location, as_of="2024-12-31")
    assert not (tmp_path / "data").exists()
    tables.load_tables(broken, location, checked=False)
    assert tables.read_table(spark, contracts.CUSTOMERS, location).count() == 1


def test_append_checks_against_what_is_stored(spark, frames, tmp_path):
    location = str(tmp_path / "data")
    sold = frames["transactions"]
    with pytest.raises(tables.FailedChecks, match="neither given nor stored"):
        tables.load_tables({"transactions": sold}, location, as_of="2024-12-31")
    tables.load_tables(frames, location, as_of="2024-12-31")
    later = sold.withColumn("transaction_id", F.col("transaction_id") + 10)
    tables.load_tables({"transactions": later}, location, as_of="2024-12-31")
    assert tables.read_table(spark, contracts.TRANSACTIONS, location).count() == 4
    orphan = later.withColumns(
        {"transaction_id": F.col("transaction_id") + 10, "customer_id": F.lit(77)}
    )
    with pytest.raises(tables.FailedChecks, match="transactions.customer_id: references"):
        tables.load_tables({"transactions": orphan}, location, as_of="2024-12-31")
    with pytest.raises(tables.FailedChecks, match="transactions.transaction_id: new_key"):
        tables.load_tables({"transactions": later}, location, as_of="2024-12-31")


@pytest.mark.parametrize(
    "column, value", [("amount", 1e12), ("unit_price", 1e9), ("transaction_date", "soon")]
)
def test_values_that_do_not_convert_are_named(frames, tmp_path, column, value):
    broken = {**frames, "transactions": frames["transactions"].withColumn(column, F.lit(value))}
    with pytest.raises(tables.FailedChecks, match=f"transactions.{column}: castable"):
        tables.load_tables(broken, str(tmp_path / "data"), as_of="2024-12-31")


@pytest.mark.parametrize(
    "url, jdbc",
    [
        ("postgresql:///db", "jdbc:postgresql://localhost/db"),
        ("postgresql://[::1]:5433/db", "jdbc:postgresql://[::1]:5433/db"),
        ("postgresql://u@h/db?sslmode=require", "jdbc:postgresql://h/db?sslmode=require"),
    ],
)
def test_database_urls(url, jdbc):
    assert tables.jdbc_options(url)["url"] == jdbc


def test_full_contract_report(spark, frames):
    ready = {
        name: tables.conform(frame, contracts.TABLES[name]) for name, frame in frames.items()
    }
    report = check_tables(ready, as_of="2024-12-31", minimum_transactions=10)
    assert failures(report) == ["transactions.*: volume broken by 8 rows"]
    assert report.count() > 60
    late = check_tables(ready, as_of="2024-03-01")
    assert failures(late) == ["transactions.transaction_date: not_future broken by 1 rows"]


def test_unknown_mode(frames):
    with pytest.raises(ValueError):
        tables.load_tables(frames, "x", mode="merge")


def test_load_summary(frames):
    got = {r.table: r for r in tables.load_summary(frames).collect()}
    assert got["customers"].row_count == 2 and got["customers"].total_revenue is None
    assert got["transactions"].total_revenue == Decimal("12.00")


def test_saved_months_round_trip_and_prune(spark, frames, tmp_path):
    sold = tables.conform(frames["transactions"], contracts.TRANSACTIONS)
    april = sold.withColumn("transaction_date", F.lit("2024-04-05").cast("date"))
    tables.save_by_month(sold.unionByName(april), str(tmp_path / "months"))
    march = tables.read_months(spark, str(tmp_path / "months"), "2024-03-01", "2024-03-31")
    assert bag(march) == bag(sold)
    assert tables.read_months(spark, str(tmp_path / "months"), "2024-03-02", "2024-04-30").count() == 3
    scanned = march._jdf.queryExecution().executedPlan().toString()
    pruned = scanned.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "transaction_month" in pruned


def test_a_month_with_most_rows_is_split(spark, tmp_path):
    rows = spark.range(40000).select(
        F.col("id").alias("customer_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("filler"),
        F.when(F.col("id") % 10 == 0, F.lit("2024-01-01"))
        .otherwise(F.lit("2024-02-01"))
        .cast("date")
        .alias("transaction_date"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "200k")
    try:
        tables.save_by_month(rows.repartition(8), str(tmp_path / "months"))
    finally:
        spark.conf.unset(setting)
    files = list((tmp_path / "months" / "transaction_month=2024-02-01").glob("*.parquet"))
    assert len(files) > 2


def test_bucketed_tables_join_without_a_shuffle_of_the_sales(spark, frames, small_limits):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    tables.load_tables(frames, "catalog:bucketed", as_of="2024-12-31", buckets=4)
    stored = tables.read_tables(spark, "catalog:bucketed")
    people, sold = stored["customers"], stored["transactions"]

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    joins = {
        "totals": churn.customer_activity(people, sold, "2024-12-31"),
        "dates": check_date_order(
            sold, "t", "customer_id", "transaction_date", people, "customer_id", "signup_date"
        ),
        "months": cohort.cohort_retention(people, sold),
    }
    for name, df in joins.items():
        assert "Bucketed: true" in plan(df), name
        assert "hashpartitioning(customer_id" not in plan(df), name
    plain = {name: tables.conform(frames[name], contracts.TABLES[name]) for name in frames}
    again = cohort.cohort_retention(plain["customers"], plain["transactions"])
    assert bag(joins["months"]) == bag(again) and bag(again)
    later = frames["transactions"].withColumn("transaction_id", F.col("transaction_id") + 10)
    tables.load_tables({"transactions": later}, "catalog:bucketed", as_of="2024-12-31", buckets=4)
    assert tables.read_table(spark, contracts.TRANSACTIONS, "catalog:bucketed").count() == 4


def test_only_catalogs_are_bucketed(frames, tmp_path):
    with pytest.raises(ValueError):
        tables.load_tables(frames, str(tmp_path), buckets=4)


def test_probe(frames):
    got = dict(bag(tables.probe({**frames, "none": frames["stores"].filter("false")})))
    assert got["stores"] and not got["none"]


def test_scalar(spark):
    assert tables.scalar(spark.range(5).groupBy().count()) == 5
    for rows in (0, 2):
        with pytest.raises(ValueError):
            tables.scalar(spark.range(rows))


def test_locations(monkeypatch):
    monkeypatch.delenv("DATABASE_URL", raising=False)
    assert tables.table_location() == tables.DEFAULT_LOCATION
    monkeypatch.setenv("DATABASE_URL", "sqlite:///x.db")
    assert tables.table_location() == "sqlite:///x.db"
    assert tables.table_location("/data") == "/data"


def test_jdbc_options():
    assert tables.jdbc_options("/data/tables") is None
    assert tables.jdbc_options("sqlite:////tmp/x.db") == {"url": "jdbc:sqlite:/tmp/x.db"}
    assert tables.jdbc_options("jdbc:x:y") == {"url": "jdbc:x:y"}
    assert tables.jdbc_options("postgresql+psycopg2://me:p%40ss@db:5433/shop") == {
        "url": "jdbc:postgresql://db:5433/shop",
        "user": "me",
        "password": "p@ss",
    }


def test_jdbc_reads_are_split_on_the_key():
    assert tables.split_options("id", 1, 1000, 8) == {
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "1001",
        "numPartitions": "8",
    }
    assert tables.split_options("id", 5, 6, 8)["numPartitions"] == "2"


def test_created_tables_fill_defaults_and_hold_lengths(spark, frames):
    spark.sql("CREATE DATABASE IF NOT EXISTS created")
    tables.create_tables(spark, "catalog:created")
    tables.create_tables(spark, "catalog:created")  # a refresh
    spark.sql(
        "INSERT INTO created.customers "
        "(customer_id, first_name, last_name, email, state, postcode, signup_date) "
        "VALUES (5, 'Cy', 'Orr', 'cy@x.au', 'WA', '6000', DATE '2024-01-01')"
    )
    row = spark.table("created.customers").first()
    assert row.loyalty_program == "None" and row.created_at is not None and row.phone is None
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql("INSERT INTO created.products VALUES (1, 'x', 'Bakery', 'y', 'far too long', 1)")
    tables.load_tables(frames, "catalog:created", as_of="2024-12-31")
    assert spark.table("created.customers").count() == 3
    assert spark.table("created.transactions").first().discount_amount == 0
