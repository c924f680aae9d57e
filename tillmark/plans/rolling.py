"""Rolling revenue and basket value per state over a gap-free calendar.

A basket is one transaction row; the 30-day basket is the plain mean of the
daily means, days without sales counting as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.money import mean
from tillmark.operators.lookup import lookup
from tillmark.operators.spine import calendar_spine, date_bounds
from tillmark.operators.trailing import change_percent, previous, trailing_rows, trailing_sum
from tillmark.session import cut_lineage

DAY = "transaction_date"


def sales_by_state_day(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Sums per state and day with sales; unknown stores end up under a NULL state.

    Sums per store and day are built first, so that only those, not the
    transactions, meet the stores. Types do not depend on the number of stores.
    """
    sold = transactions.groupBy("store_id", DAY).agg(
        F.sum("amount").alias("_revenue"),
        F.count("transaction_id").alias("_sales"),
        F.count("amount").alias("_amounts"),
    )
    money = sold.schema["_revenue"].dataType
    return (
        lookup(sold, stores.select("store_id", "state"), ["store_id"], "left")
        .groupBy("state", DAY)
        .agg(
            F.sum("_revenue").cast(money).alias("_revenue"),
            F.sum("_sales").alias("_sales"),
            F.sum("_amounts").alias("_amounts"),
        )
    )


def sales_calendar(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Every state of a store with every day of trade."""
    first, last = date_bounds(transactions, DAY)
    return calendar_spine(stores, ["state"], first, last, DAY)


def daily_sales(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue, transactions and mean basket per state and day, 0 on days without sales.

    The sums (at most states x days) are written once, so that the calendar's
    bounds come from them and not from a second scan of the transactions.
    """
    sold = cut_lineage(sales_by_state_day(transactions, stores))
    zero = F.lit(0)
    return (
        sales_calendar(sold, stores)
        .join(sold, ["state", DAY], "left")
        .select(
            "state",
            DAY,
            F.coalesce("_revenue", zero).alias("daily_revenue"),
            F.coalesce("_sales", zero).alias("daily_transactions"),
            F.coalesce(mean(F.col("_revenue"), F.col("_amounts")), zero).alias(
                "daily_avg_basket"
            ),
        )
    )


def rolling_revenue(
    transactions: DataFrame, stores: DataFrame, short: int = 7, long: int = 30
) -> DataFrame:
    """Daily sales with trailing sums, trailing basket value and change on the day before."""
    keys = ["state"]
    basket_sum = trailing_sum("daily_avg_basket", keys, DAY, long)
    rolled = daily_sales(transactions, stores).select(
        "*",
        trailing_sum("daily_revenue", keys, DAY, short).alias("_short"),
        trailing_sum("daily_revenue", keys, DAY, long).alias("_long"),
        basket_sum.alias("_basket_sum"),
        trailing_rows(keys, DAY, long).alias("_basket_days"),
        previous("daily_revenue", keys, DAY).alias("_before"),
    )
    return rolled.select(
        "state",
        DAY,
        "daily_revenue",
        "daily_transactions",
        F.round("daily_avg_basket", 2).alias("daily_avg_basket"),
        F.round("_short", 2).alias(f"revenue_last_{short}_days"),
        F.round("_long", 2).alias(f"revenue_last_{long}_days"),
        # Rounding to 14 places first takes back what the daily means lost there.
        F.round(mean(F.col("_basket_sum"), F.col("_basket_days")), 2).alias(
            f"avg_basket_last_{long}_days"
        ),
        change_percent(F.col("daily_revenue"), F.col("_before")).alias(
            "day_over_day_pct_change"
        ),
    ).orderBy("state", DAY)
