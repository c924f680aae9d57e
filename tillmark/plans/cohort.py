"""Monthly signup cohorts and their retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import month_number, month_start
from tillmark.functions.money import percent


def cohort_sizes(customers: DataFrame) -> DataFrame:
    """Signups per month, customers who never bought included.

    There is one row per calendar month, and the DATE type has fewer than
    120,000 of them, so the result may be broadcast.
    """
    return _with_cohort(customers).groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))


def assign_cohorts(customers: DataFrame) -> DataFrame:
    """Each customer's cohort month and its size.

    The size is counted first and joined back: a window over the month would
    put a whole cohort, possibly a third of all customers, in one task.
    """
    sizes = cohort_sizes(customers)
    # Null-safe, as customers without a signup date form a cohort of their own.
    same_month = F.col("c.cohort_month").eqNullSafe(F.col("s.cohort_month"))
    return (
        _with_cohort(customers)
        .alias("c")
        .join(F.broadcast(sizes).alias("s"), same_month)
        .select("c.customer_id", "c.cohort_month", "s.cohort_size")
    )


def monthly_activity(transactions: DataFrame) -> DataFrame:
    """Distinct customer and month of purchase."""
    return transactions.select(
        "customer_id", month_start(F.col("transaction_date")).alias("activity_month")
    ).distinct()


def cohort_retention(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Share of each cohort that bought N months after signup, one row per month.

    A customer belongs to one cohort and appears once per month, so active
    customers are plain counts; the cohort size is joined to the finished
    counts, not to the customers. The months of a customer (a set bounded by
    the calendar) are gathered by the one shuffle of the transactions, whose
    partitioning the join reuses.
    """
    cohort, activity = F.col("cohort_month"), F.col("activity_month")
    bought = transactions.groupBy("customer_id").agg(
        F.collect_set(month_start(F.col("transaction_date"))).alias("_months")
    )
    active = (
        _with_cohort(customers)
        .join(bought, "customer_id")
        .select("cohort_month", F.explode("_months").alias("activity_month"))
        .filter(activity >= cohort)
        .groupBy(cohort, month_number(cohort, activity).alias("month_number"))
        .agg(F.count("*").alias("active_customers"))
    )
    return (
        active.join(F.broadcast(cohort_sizes(customers)), "cohort_month")
        .select(
            "cohort_month",
            "cohort_size",
            "month_number",
            "active_customers",
            percent(F.col("active_customers"), F.col("cohort_size"), 1).alias("retention_pct"),
        )
        .orderBy("cohort_month", "month_number")
    )


def _with_cohort(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", month_start(F.col("signup_date")).alias("cohort_month"))
