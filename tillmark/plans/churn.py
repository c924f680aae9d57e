"""Churn risk: high spenders who have stopped buying."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import as_of_date, days_between
from tillmark.functions.money import round_ratio
from tillmark.functions.text import full_name
from tillmark.operators.ranking import one_tier, spend_tiers
from tillmark.session import cut_lineage

AsOf = str | datetime.date | Column | None

PROFILE = ["first_name", "last_name", "state", "loyalty_program"]


def purchase_totals(transactions: DataFrame) -> DataFrame:
    """Purchases per customer id, as sums and counts.

    One shuffle of partial sums on ``customer_id``: each task sends a customer
    at most once, so a customer with very many purchases stays cheap.
    """
    return transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount").alias("lifetime_spend"),
        F.count("amount").alias("_amounts"),
        F.max("transaction_date").alias("last_transaction_date"),
    )


def with_averages(totals: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Append what follows from the totals of a customer.

    Kept apart so that plans can rank on the totals and pay for the exact
    division only on the rows they keep.
    """
    return totals.select(
        *[name for name in totals.columns if name != "_amounts"],
        round_ratio(F.col("lifetime_spend"), F.col("_amounts"), 2).alias("avg_transaction_value"),
        days_between(F.col("last_transaction_date"), as_of_date(as_of)).alias(
            "days_since_last_purchase"
        ),
    )


def customer_activity(
    customers: DataFrame, transactions: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Profile and purchase summary of every customer who ever bought."""
    summary = with_averages(purchase_totals(transactions), as_of)
    return customers.select("customer_id", *PROFILE).join(summary, "customer_id")


def risk_level(days: Column, critical_days: int = 90, high_days: int = 60) -> Column:
    return (
        F.when(days >= critical_days, "Critical").when(days >= high_days, "High").otherwise("Low")
    )


def active_customers(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Purchase totals of the known customers, on disk: tiers read them several times.

    Only the totals go through the ranking; profiles are joined to the few rows that are kept
    afterwards.
    """
    return cut_lineage(
        purchase_totals(transactions).join(
            customers.select("customer_id"), "customer_id", "left_semi"
        )
    )


def scored_customers(
    customers: DataFrame, transactions: DataFrame, as_of: AsOf = None, tiers: int = 4
) -> DataFrame:
    """Purchases with tier, rank and revenue share among all active customers."""
    active = active_customers(customers, transactions)
    return with_averages(spend_tiers(active, "lifetime_spend", ["customer_id"], tiers), as_of)


def churn_risk(
    customers: DataFrame,
    transactions: DataFrame,
    as_of: AsOf = None,
    min_days: int = 60,
    critical_days: int = 90,
    tier: int = 1,
    tiers: int = 4,
) -> DataFrame:
    """Customers of one spend tier who have not bought for ``min_days`` or longer."""
    active = active_customers(customers, transactions)
    in_tier = one_tier(active, "lifetime_spend", ["customer_id"], tier, tiers)
    at_risk = with_averages(in_tier, as_of).filter(F.col("days_since_last_purchase") >= min_days)
    return (
        customers.select("customer_id", *PROFILE)
        .join(at_risk, "customer_id")
        .select(
            "customer_id",
            full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
            "state",
            "loyalty_program",
            "total_transactions",
            F.round("lifetime_spend", 2).alias("lifetime_spend"),
            "avg_transaction_value",
            "last_transaction_date",
            "days_since_last_purchase",
            "spend_rank",
            "pct_of_total_revenue",
            risk_level(F.col("days_since_last_purchase"), critical_days).alias(
                "churn_risk_level"
            ),
        )
        .orderBy(
            F.col("lifetime_spend").desc_nulls_first(),
            F.col("days_since_last_purchase").desc_nulls_first(),
            # Keeps equal rows from sharing one range, and the order defined.
            "customer_id",
        )
    )
