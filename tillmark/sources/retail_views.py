"""The four retail tables as views over order-processing Parquet tables.

Each view takes only the scans and joins its columns need: store-level work
never touches ``orders``. Schemas are declared, so that opening a table runs no
job to infer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark.operators.joined import Joined

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}

# Whole cents come first (rint stays in binary); one conversion to DECIMAL at
# the end is exact below 2**53 cents and cheaper than decimal arithmetic per row.
_CENTS = "cast(rint(l_extendedprice * 100) as bigint)"
_DISCOUNT_CENTS = f"(({_CENTS} * cast(rint(l_discount * 100) as bigint) + 50) div 100)"
_QUANTITY = "cast(l_quantity as int)"

_LINE_COLUMNS = [
    "l_orderkey * 10 + l_linenumber AS transaction_id",
    "l_suppkey AS store_id",
    "l_partkey AS product_id",
    "cast(l_shipdate as date) AS transaction_date",
    f"{_QUANTITY} AS quantity",
    f"cast((({_CENTS} * 2 + {_QUANTITY}) div ({_QUANTITY} * 2)) / 100D as decimal(18,2))"
    " AS unit_price",
    f"cast({_DISCOUNT_CENTS} / 100D as decimal(18,2)) AS discount_amount",
    f"cast(({_CENTS} - {_DISCOUNT_CENTS}) / 100D as decimal(18,2)) AS amount",
]


_CUSTOMER_COLUMNS = {
    "customer_id": "c_custkey",
    "first_name": "split(c_name, '#')[0]",
    "last_name": "split(c_name, '#')[1]",
    "email": "lower(c_name) || '@example.com.au'",
    "signup_date": "date_add(DATE '1994-07-01', cast(c_custkey * 7919 % 910 as int))",
}


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _customer_columns(*names: str) -> list[str]:
    return [f"{_CUSTOMER_COLUMNS[name]} AS {name}" for name in names]


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = scan(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return (
        scan(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .selectExpr(
            *_customer_columns("customer_id", "first_name", "last_name", "email"),
            "n_name AS state",
            "c_mktsegment AS loyalty_program",
            *_customer_columns("signup_date"),
        )
    )


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the number of their nation instead of its name; none is left out."""
    return scan(spark, folder, "customer").selectExpr(
        *_customer_columns(*_CUSTOMER_COLUMNS), "c_nationkey"
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    region = scan(spark, folder, "region").selectExpr("r_regionkey AS n_regionkey", "r_name")
    places = (
        scan(spark, folder, "nation")
        .join(region, "n_regionkey")
        .selectExpr("n_nationkey AS s_nationkey", "r_name")
    )
    return (
        scan(spark, folder, "supplier")
        .join(places, "s_nationkey")
        .selectExpr(
            "s_suppkey AS store_id",
            "s_name AS store_name",
            "CASE s_suppkey % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'North Express'"
            " WHEN 2 THEN 'South' ELSE 'South Local' END AS banner",
            "if((s_suppkey % 4 < 2) = (s_suppkey % 25 != 7), 'North Group', 'South Group')"
            " AS parent_group",
            "r_name AS state",
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "p_brand AS brand",
        "cast(p_retailprice as decimal(8,2)) AS unit_price",
    )


def store_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions without the columns that live on the order."""
    return scan(spark, folder, "lineitem").selectExpr(*_LINE_COLUMNS)


def transaction_parts(spark: SparkSession, folder: str) -> Joined:
    """The rows of ``transactions``, as the lines and the orders they are joined from."""
    return Joined(
        scan(spark, folder, "lineitem").selectExpr("l_orderkey", *_LINE_COLUMNS),
        scan(spark, folder, "orders").selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey AS customer_id", "o_orderpriority AS payment_method"
        ),
        "l_orderkey",
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with customer and payment method."""
    orders = scan(spark, folder, "orders").selectExpr(
        "o_orderkey AS l_orderkey", "o_custkey", "o_orderpriority"
    )
    return (
        scan(spark, folder, "lineitem")
        .join(orders, "l_orderkey")
        .selectExpr(
            *_LINE_COLUMNS, "o_custkey AS customer_id", "o_orderpriority AS payment_method"
        )
    )
