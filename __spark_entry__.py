"""Registered queries and their SQL twins."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracles import ORACLES  # noqa: E402
from tillmark.functions import dates, draws, money, text  # noqa: E402
from tillmark.operators import quality, sampling  # noqa: E402
from tillmark.operators.incremental import incremental_report  # noqa: E402
from tillmark.operators.lookup import lookup, lookup_skewed  # noqa: E402
from tillmark.operators.ranking import spend_tiers  # noqa: E402
from tillmark.operators.trailing import change_percent, previous  # noqa: E402
from tillmark.plans import churn, cohort, rolling  # noqa: E402
from tillmark.session import ensure_checkpoint_dir  # noqa: E402
from tillmark.sources import contracts, retail_views as views, tables  # noqa: E402

try:
    import corpus_pipeline
    import tillmark.llm.queries as llm
except ModuleNotFoundError as missing:
    # The text operators and their pipeline are optional; anything else missing is an error.
    if missing.name not in ("corpus_pipeline", "tillmark.llm", "tillmark.llm.queries"):
        raise
    corpus_pipeline = llm = None

AS_OF = "2001-12-31"
SEED = 42

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    def plain(spark: SparkSession, folder: str) -> DataFrame:
        return _plain_types(query(spark, folder))

    _QUERIES[query.__name__] = plain
    return query


def _plain_types(df: DataFrame) -> DataFrame:
    """DECIMAL as DOUBLE and INT as BIGINT, so that other engines' types line up."""
    plain = {T.DecimalType: "double", T.IntegerType: "bigint"}
    return df.select(
        *[
            F.col(f.name).cast(plain[type(f.dataType)]) if type(f.dataType) in plain else f.name
            for f in df.schema.fields
        ]
    )


def entry(spark: SparkSession) -> DataFrame:
    return queries()["churn_risk"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    if llm is None:
        return dict(_QUERIES)
    whole = {"pipeline": lambda spark, folder: corpus_pipeline.run(spark, folder)}
    return {**_QUERIES, **llm.QUERIES, **whole}


def oracle_sql() -> dict[str, str]:
    own = {name: ORACLES[name] for name in _QUERIES if name in ORACLES}
    if llm is None:
        return own
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**own, **llm.ORACLES, **whole}


# Sources -------------------------------------------------------------------


def _retail(spark, folder, sales=views.store_sales):
    return {
        "customers": views.customers(spark, folder),
        "stores": views.stores(spark, folder),
        "products": views.products(spark, folder),
        "transactions": sales(spark, folder),
    }


@_register
def scan_summary(spark, folder):
    return tables.load_summary(_retail(spark, folder))


@_register
def existence_probe(spark, folder):
    return tables.probe(_retail(spark, folder))


@_register
def load_ready(spark, folder):
    """Customers as the load step writes them: contract types, defaults filled in."""
    arriving = views.customers(spark, folder).select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        F.lit("NSW").alias("state"),
        text.padded(F.col("customer_id") % 10000, 4).alias("postcode"),
        dates.iso_text(F.col("signup_date")).alias("signup_date"),
    )
    return tables.conform(arriving, contracts.CUSTOMERS).drop("created_at")


# Churn ---------------------------------------------------------------------


@_register
def customer_activity(spark, folder):
    return churn.customer_activity(
        views.customers(spark, folder), views.transactions(spark, folder), AS_OF
    )


@_register
def all_spend_tiers(spark, folder):
    return churn.scored_customers(
        views.customers(spark, folder), views.transactions(spark, folder), AS_OF
    )


@_register
def tiers_with_ties(spark, folder):
    """Parts ranked by size, which has only some 50 values: long runs of ties."""
    parts = views.scan(spark, folder, "part").select("p_partkey", "p_size")
    return spend_tiers(
        parts, "p_size", ["p_partkey"], 7, "size_tier", "size_rank", "pct_of_total", 2
    )


@_register
def churn_risk(spark, folder):
    return churn.churn_risk(
        views.customers(spark, folder), views.transactions(spark, folder), AS_OF
    )


# Cohorts -------------------------------------------------------------------


@_register
def cohort_size(spark, folder):
    return cohort.cohort_sizes(views.customers(spark, folder))


@_register
def assign_cohorts(spark, folder):
    return cohort.assign_cohorts(views.customers(spark, folder))


@_register
def monthly_activity(spark, folder):
    return cohort.monthly_activity(views.transactions(spark, folder))


@_register
def cohort_retention(spark, folder):
    return cohort.cohort_retention(
        views.customers(spark, folder), views.transactions(spark, folder)
    )


# Rolling revenue -----------------------------------------------------------


@_register
def calendar_spine(spark, folder):
    return rolling.sales_calendar(views.store_sales(spark, folder), views.stores(spark, folder))


@_register
def daily_sales(spark, folder):
    daily = rolling.daily_sales(views.store_sales(spark, folder), views.stores(spark, folder))
    return daily.withColumn("daily_avg_basket", F.round("daily_avg_basket", 2))


@_register
def rolling_revenue(spark, folder):
    return rolling.rolling_revenue(views.store_sales(spark, folder), views.stores(spark, folder))


@_register
def day_over_day(spark, folder):
    daily = rolling.daily_sales(views.store_sales(spark, folder), views.stores(spark, folder))
    return daily.select(
        "state",
        "transaction_date",
        "daily_revenue",
        previous("daily_revenue", ["state"], "transaction_date").alias("prior_day_revenue"),
    ).withColumn("pct_change", change_percent(F.col("daily_revenue"), F.col("prior_day_revenue")))


# Data quality --------------------------------------------------------------


@_register
def dq_volume(spark, folder):
    return quality.all_reports(
        [
            quality.check_volume(views.customers(spark, folder), "customers"),
            quality.check_volume(views.stores(spark, folder), "stores"),
            quality.check_volume(views.products(spark, folder), "products"),
            quality.check_volume(views.store_sales(spark, folder), "transactions", 10_000),
            quality.check_volume(views.scan(spark, folder, "nation"), "nation", 30),
        ]
    )


@_register
def dq_nulls(spark, folder):
    lines = views.transactions(spark, folder).withColumn(
        "line_number", F.nullif(F.col("transaction_id") % 10, F.lit(7))
    )
    critical = ["customer_id", "store_id", "product_id", "amount", "transaction_date"]
    return quality.check_rows(lines, "transactions", quality.not_null(*critical, "line_number"))


@_register
def dq_positive(spark, folder):
    checks = quality.positive("amount", "unit_price", "quantity", "discount_amount")
    return quality.check_rows(
        views.store_sales(spark, folder),
        "transactions",
        checks + quality.not_negative("discount_amount"),
    )


@_register
def dq_line_total(spark, folder):
    return quality.check_rows(
        views.store_sales(spark, folder), "transactions", [quality.within_line_total()]
    )


def _lost(key: str):
    """The key, with every tenth one turned into one that no parent has."""
    return F.when(F.col(key) % 10 == 0, -F.col(key) - 1).otherwise(F.col(key))


@_register
def dq_orphans(spark, folder):
    sales = views.transactions(spark, folder)
    sales = sales.withColumns({"customer_id": _lost("customer_id"), "product_id": _lost("product_id")})
    people, parts = views.scan(spark, folder, "customer"), views.scan(spark, folder, "part")
    return quality.all_reports(
        [
            quality.check_references(sales, "transactions", "customer_id", people, "c_custkey"),
            quality.check_references(
                sales, "transactions", "store_id", views.stores(spark, folder), "store_id"
            ),
            quality.check_references(sales, "transactions", "product_id", parts, "p_partkey"),
        ]
    )


@_register
def dq_orphan_keys(spark, folder):
    sales = views.store_sales(spark, folder).withColumn("product_id", _lost("product_id"))
    return quality.orphan_keys(sales, "product_id", views.scan(spark, folder, "part"), "p_partkey")


@_register
def dq_orphan_rows(spark, folder):
    sales = views.store_sales(spark, folder).select(
        "transaction_id", F.nullif(_lost("product_id"), F.lit(3)).alias("product_id"), "amount"
    )
    return quality.orphan_rows(sales, "product_id", views.scan(spark, folder, "part"), "p_partkey")


@_register
def dq_unique(spark, folder):
    people = views.customers(spark, folder)
    return quality.all_reports(
        [
            quality.check_unique(people, "customers", ["email"]),
            quality.check_unique(people, "customers", ["customer_id"]),
            quality.check_unique(views.stores(spark, folder), "stores", ["store_id"]),
            quality.check_unique(views.products(spark, folder), "products", ["product_id"]),
            quality.check_unique(
                views.store_sales(spark, folder), "transactions", ["transaction_id"]
            ),
        ]
    )


@_register
def dq_duplicate_keys(spark, folder):
    return quality.duplicate_keys(views.store_sales(spark, folder), ["transaction_id"])


_KNOWN_STATES = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
_KNOWN_PAYMENTS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@_register
def dq_domain(spark, folder):
    return quality.all_reports(
        [
            quality.check_rows(
                views.stores(spark, folder),
                "stores",
                [
                    quality.in_domain("state", _KNOWN_STATES),
                    quality.in_domain("banner", ["North", "North Express", "South", "South Local"]),
                ],
            ),
            quality.check_rows(
                views.transactions(spark, folder),
                "transactions",
                [quality.in_domain("payment_method", _KNOWN_PAYMENTS)],
            ),
        ]
    )


@_register
def dq_unexpected_values(spark, folder):
    return quality.unexpected_values(
        views.transactions(spark, folder), "payment_method", _KNOWN_PAYMENTS
    )


@_register
def dq_conditional_domain(spark, folder):
    groups = {
        "North Group": ["North", "North Express"],
        "South Group": ["South", "South Local"],
    }
    return quality.check_rows(
        views.stores(spark, folder),
        "stores",
        [quality.matches_group("banner", "parent_group", groups)],
    )


@_register
def dq_date_order(spark, folder):
    lines = views.scan(spark, folder, "lineitem")
    orders = views.scan(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return quality.all_reports(
        [
            quality.check_date_order(
                views.transactions(spark, folder),
                "transactions",
                "customer_id",
                "transaction_date",
                views.customers(spark, folder),
                "customer_id",
                "signup_date",
            ),
            quality.check_rows(
                lines.join(orders, "l_orderkey"),
                "lineitem",
                [quality.not_before("l_shipdate", "o_orderdate")],
            ),
        ]
    )


@_register
def dq_future(spark, folder):
    return quality.check_rows(
        views.store_sales(spark, folder),
        "transactions",
        [quality.not_future("transaction_date", "2001-06-30")],
    )


@_register
def dq_length(spark, folder):
    return quality.all_reports(
        [
            quality.check_rows(
                views.customers(spark, folder),
                "customers",
                [quality.max_length("email", 255), quality.max_length("loyalty_program", 9)],
            ),
            quality.check_rows(
                views.products(spark, folder), "products", [quality.max_length("product_name", 9)]
            ),
        ]
    )


@_register
def dq_numeric_range(spark, folder):
    return quality.check_rows(
        views.scan(spark, folder, "lineitem"),
        "lineitem",
        [
            quality.fits_numeric("l_extendedprice", 6, 2),
            quality.fits_numeric("l_extendedprice", 8, 2),
            quality.fits_numeric("l_quantity", 3, 2),
        ],
    )


@_register
def dq_violating_rows(spark, folder):
    checks = [
        quality.within_line_total(),
        quality.not_future("transaction_date", "2001-10-31"),
    ]
    bad = quality.violating_rows(views.store_sales(spark, folder), checks)
    return bad.select(
        "transaction_id",
        "transaction_date",
        "amount",
        F.array_join("broken_checks", "; ").alias("broken_checks"),
    )


@_register
def dq_integrity_suite(spark, folder):
    frames = _retail(spark, folder, views.transaction_parts)
    return quality.integrity_suite(frames, AS_OF, states=["NATION_1", "NATION_2", "NATION_3"])


@_register
def dq_incremental(spark, folder):
    """The first run of an incremental check; its state lies in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    state = f"{spark.sparkContext.getCheckpointDir()}/checked-{uuid4().hex}"
    checks = [
        *quality.positive("l_quantity"),
        *quality.not_null("l_shipdate"),
        quality.RowCheck("high_discount", "l_discount", F.col("l_discount") > 0.09),
    ]
    report, _ = incremental_report(
        spark, f"{folder}/lineitem.parquet", state, "lineitem", checks, 10_000
    )
    return report


def _contract_frames(spark, folder):
    """The four tables with every column that their contracts ask for."""
    people, shops = views.customers(spark, folder), views.stores(spark, folder)
    return {
        "customers": people.withColumn(
            "postcode", text.padded(F.col("customer_id") % 10000, 4)
        ),
        "stores": shops.withColumns(
            {"suburb": F.col("store_name"), "postcode": text.padded(F.col("store_id") % 10000, 4)}
        ),
        "products": views.products(spark, folder),
        "transactions": views.transactions(spark, folder),
    }


@_register
def dq_contract_report(spark, folder):
    """Every rule of the four contracts, over tables conformed to them."""
    frames = _contract_frames(spark, folder)
    frames["transactions"] = views.transaction_parts(spark, folder)
    ready = {name: tables.conform(frame, contracts.TABLES[name]) for name, frame in frames.items()}
    return quality.check_tables(ready, AS_OF)


@_register
def load_round_trip(spark, folder):
    """Loaded into a fresh folder, appended to, replaced in part, and read back."""
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/loaded-{uuid4().hex}"
    frames = _contract_frames(spark, folder)
    late = F.col("transaction_date") >= "2000-01-01"
    # The given tables keep other domains than the contracts, so the checks are left out.
    tables.load_tables(
        {**frames, "transactions": frames["transactions"].filter(~late)}, place, checked=False
    )
    tables.load_tables(
        {"transactions": frames["transactions"].filter(late)}, place, checked=False
    )
    few = frames["products"].filter("product_id % 2 = 0")
    tables.load_tables({"products": few}, place, mode="overwrite", checked=False)
    return tables.load_summary(tables.read_tables(spark, place))


# Sampling ------------------------------------------------------------------


def _draw(stream: str, *key: str):
    return draws.draw(SEED, stream, *[F.col(name) for name in key])


def _orders(spark, folder):
    """One wanted sample per order, with the region of its customer."""
    regions = views.scan(spark, folder, "region").selectExpr(
        "r_regionkey AS n_regionkey", "r_name AS state"
    )
    nations = views.scan(spark, folder, "nation").join(regions, "n_regionkey")
    people = views.scan(spark, folder, "customer").join(
        nations.selectExpr("n_nationkey AS c_nationkey", "state"), "c_nationkey"
    )
    return (
        views.scan(spark, folder, "orders")
        .join(people.selectExpr("c_custkey AS o_custkey", "state"), "o_custkey")
        .select("o_orderkey", "state")
    )


def _frequencies(df, column):
    """The values of a short column in order, with their row counts."""
    return {row[0]: row[1] for row in df.groupBy(column).count().orderBy(column).collect()}


@_register
def weighted_choice(spark, folder):
    """Values drawn as often as they occur in the tables."""
    orders, lines = views.scan(spark, folder, "orders"), views.scan(spark, folder, "lineitem")
    choices = {
        "payment_method": ("payment", _frequencies(orders, "o_orderpriority")),
        "line_number": ("line", _frequencies(lines, "l_linenumber")),
        "return_flag": ("flag", _frequencies(lines, "l_returnflag")),
    }
    # Draws are columns of their own, so that each is computed once, not per branch.
    drawn = orders.select(
        "o_orderkey", *[_draw(stream, "o_orderkey").alias(stream) for stream, _ in choices.values()]
    )
    return drawn.select(
        "o_orderkey",
        *[
            draws.weighted_choice(F.col(stream), list(weights), list(weights.values())).alias(name)
            for name, (stream, weights) in choices.items()
        ],
    )


@_register
def normalise_weights(spark, folder):
    weighted = views.scan(spark, folder, "customer").selectExpr(
        "c_custkey", "cast(abs(c_acctbal) as decimal(18,2)) AS weight"
    )
    return sampling.normalise_weights(weighted, "weight", "share")


@_register
def weighted_sample(spark, folder):
    wanted = views.scan(spark, folder, "orders").select(
        "o_orderkey", _draw("customer", "o_orderkey").alias("draw")
    )
    weighted = views.scan(spark, folder, "customer").selectExpr(
        "c_custkey", "cast(abs(c_acctbal) as decimal(18,2)) AS weight"
    )
    return sampling.weighted_sample(
        wanted, "draw", ["o_orderkey"], weighted, "c_custkey", "weight"
    ).select("o_orderkey", "c_custkey")


@_register
def group_members(spark, folder):
    shops = views.stores(spark, folder).select("state", "store_id")
    return sampling.member_index(shops, "state", "store_id")


@_register
def uniform_pick(spark, folder):
    wanted = _orders(spark, folder).withColumn("draw", _draw("store", "o_orderkey"))
    return sampling.uniform_pick(
        wanted, "draw", "state", views.stores(spark, folder), "store_id"
    ).select("o_orderkey", "state", "store_id")


@_register
def affinity_assign(spark, folder):
    wanted = _orders(spark, folder).withColumns(
        {"chance": _draw("own state", "o_orderkey"), "draw": _draw("store", "o_orderkey")}
    )
    return sampling.affinity_assign(
        wanted,
        "chance",
        "draw",
        "state",
        views.stores(spark, folder),
        "store_id",
        "0.75",
    ).select("o_orderkey", "state", "store_id")


@_register
def two_stage_pick(spark, folder):
    wanted = views.scan(spark, folder, "orders").select(
        "o_orderkey",
        _draw("category", "o_orderkey").alias("category_draw"),
        _draw("product", "o_orderkey").alias("product_draw"),
    )
    return sampling.two_stage_pick(
        wanted,
        "category_draw",
        "product_draw",
        ["o_orderkey"],
        views.products(spark, folder),
        "category",
        "product_id",
        {"ECONOMY": "1.6", "PROMO": "0.4", "SMALL": "1.3"},
    ).select("o_orderkey", "category", "product_id")


@_register
def date_in_range(spark, folder):
    people = views.customers(spark, folder).select("customer_id", "signup_date")
    wanted = views.scan(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey AS customer_id"
    )
    # The last date is before some signups, which leaves the one-day span.
    bought = dates.date_in_range(
        F.col("signup_date"), F.lit("1996-06-30").cast("date"), _draw("day", "o_orderkey")
    )
    return lookup(wanted, people, ["customer_id"]).select(
        "o_orderkey", "signup_date", bought.alias("transaction_date")
    )


@_register
def price_line(spark, folder):
    """Order lines at a drawn price and discount, next to list price and the line's own discount."""
    listed = views.products(spark, folder).selectExpr(
        "product_id AS l_partkey", "unit_price AS listed_price"
    )
    key = ["l_orderkey", "l_linenumber"]
    complete = F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()
    lines = views.scan(spark, folder, "lineitem").select(
        *key,
        "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(complete, _draw("price", *key)).alias("price_draw"),
        F.when(complete, _draw("discount", *key)).alias("discount_draw"),
        F.col("l_discount").cast("decimal(4,2)").alias("listed_rate"),
    )
    spread = draws.uniform_decimal(F.col("price_draw"), *contracts.PRICE_SPREAD)
    rates = contracts.DISCOUNT_WEIGHTS
    rate = draws.weighted_choice(F.col("discount_draw"), list(rates), list(rates.values()))
    total, listed_total = F.col("line_total"), F.col("listed_total")
    return (
        lookup(lines, listed, ["l_partkey"])
        .select(
            *key,
            "l_partkey",
            "quantity",
            F.round(F.col("listed_price") * spread.cast("decimal(8,6)"), 2).alias("unit_price"),
            rate.cast("decimal(4,2)").alias("discount_rate"),
            "listed_price",
            "listed_rate",
        )
        .withColumn("line_total", money.line_total(F.col("quantity"), F.col("unit_price")))
        .withColumn("discount_amount", money.discount_amount(total, F.col("discount_rate")))
        .withColumn("amount", total - F.col("discount_amount"))
        .withColumn("listed_total", money.line_total(F.col("quantity"), F.col("listed_price")))
        .withColumn("listed_discount", money.discount_amount(listed_total, F.col("listed_rate")))
        .withColumn("listed_amount", listed_total - F.col("listed_discount"))
    )


@_register
def sales_by_group(spark, folder):
    """Sales looked up in the stores, of which one in ten sales goes to the first."""
    sales = views.store_sales(spark, folder).withColumn(
        "store_id", F.when(F.col("transaction_id") % 10 == 0, 1).otherwise(F.col("store_id"))
    )
    met = lookup_skewed(sales, views.stores(spark, folder), ["store_id"], share=0.05)
    return met.groupBy("state", "parent_group").agg(
        F.count("*").alias("sales"), F.sum("amount").alias("revenue")
    )


@_register
def next_keys(spark, folder):
    """Suppliers continue the customers' key range, richest first."""
    arriving = views.scan(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    order = [F.col("s_acctbal").desc(), F.col("s_suppkey")]
    existing = views.scan(spark, folder, "customer").withColumnRenamed("c_custkey", "new_key")
    return sampling.next_keys(arriving, order, existing, "new_key")


@_register
def contact_details(spark, folder):
    """Contact details drawn for every customer, and parts of the names, mails and dates held."""
    known = F.col("customer_id").isNotNull()
    streams = ("area", "middle", "end", "range", "code", "metro")
    drawn = views.contacts(spark, folder).withColumns(
        {name: F.when(known, _draw(name, "customer_id")) for name in streams}
    )
    postcode = F.lit(None)
    for place, ranges in enumerate(contracts.POSTCODE_RANGES.values()):
        picked = draws.pick_in_ranges(F.col("range"), F.col("code"), ranges)
        postcode = F.when(F.col("c_nationkey") % 4 == place, picked).otherwise(postcode)
    first, last = F.col("first_name"), F.col("last_name")
    return drawn.withColumn("drawn_code", postcode).select(
        "customer_id",
        text.full_name(first, last).alias("customer_name"),
        text.email_address(first, last, F.col("customer_id"), "example.com.au").alias("email"),
        text.mobile_number(
            draws.uniform_int(F.col("area"), 0, 99),
            draws.uniform_int(F.col("middle"), 0, 999),
            draws.uniform_int(F.col("end"), 0, 999),
        ).alias("phone"),
        F.when(F.col("drawn_code").isNotNull(), text.padded(F.col("drawn_code"), 4)).alias(
            "postcode"
        ),
        text.region_type(last, draws.happens(F.col("metro"), "0.75"), "7").alias("region_type"),
        text.initials(first, last).alias("initials"),
        text.after(F.col("email"), "@").alias("mail_host"),
        F.when(known, text.padded(F.col("customer_id") % 10000, 4)).alias("short_code"),
        dates.from_iso(dates.iso_text(F.col("signup_date"))).alias("signup_date"),
    )


@_register
def map_lookup(spark, folder):
    loyalty = {"North Group": "North Card"}
    return views.stores(spark, folder).select(
        "store_id",
        "parent_group",
        text.map_value(F.col("parent_group"), loyalty, "None").alias("loyalty_program"),
        text.map_value(F.col("parent_group"), loyalty).alias("loyalty_or_null"),
    )
