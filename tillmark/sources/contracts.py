"""What each of the four tables must look like."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.joined import Joined

# The domains the tables allow.
STATES = ("NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT")
LOYALTY_PROGRAMS = ("Everyday Rewards", "Flybuys", "None")
BANNERS_BY_GROUP = {
    "Woolworths Group": ("Woolworths", "Woolworths Metro"),
    "Coles Group": ("Coles", "Coles Local"),
}
REGION_TYPES = ("Metro", "Regional")
CATEGORIES = (
    "Fresh Produce",
    "Meat & Seafood",
    "Dairy & Eggs",
    "Bakery",
    "Pantry & Dry Goods",
    "Frozen Foods",
    "Beverages",
    "Snacks & Confectionery",
    "Household & Cleaning",
    "Health & Beauty",
    "Baby Care",
    "Pet Care",
    "Liquor",
)
UNITS = ("each", "kg", "g", "L", "mL", "pack")
PAYMENT_METHODS = (
    "EFTPOS",
    "Debit Card",
    "Credit Card",
    "Apple Pay",
    "Google Pay",
    "Gift Card",
    "Cash",
)
LINE_TOTAL_TOLERANCE = "0.01"

# Weights and ranges for sampling.
DISCOUNT_WEIGHTS = {"0": "0.80", "0.10": "0.08", "0.15": "0.06", "0.20": "0.04", "0.30": "0.02"}
POSTCODE_RANGES = {
    "NSW": [(2000, 2599), (2619, 2899), (2921, 2999)],
    "VIC": [(3000, 3999)],
    "QLD": [(4000, 4999)],
    "SA": [(5000, 5799)],
}
PRICE_SPREAD = ("0.95", "1.05")

NOW = "now"


@dataclass(frozen=True)
class Field:
    """A column; ``floor`` is "positive" or "not_negative", ``default`` a literal or NOW."""

    name: str
    type: str
    nullable: bool = False
    default: object = None
    max_length: int | None = None
    domain: tuple[str, ...] | None = None
    floor: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    primary_key: str
    unique: tuple[str, ...] = ()
    # column -> (parent table, parent column)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.DataType.fromDDL(f.type), f.nullable) for f in self.fields]
        )


def _text(name: str, length: int, **rules) -> Field:
    return Field(name, "string", max_length=length, **rules)


CUSTOMERS = Table(
    "customers",
    (
        Field("customer_id", "int"),
        _text("first_name", 50),
        _text("last_name", 50),
        _text("email", 255),
        _text("phone", 20, nullable=True),
        _text("state", 3, domain=STATES),
        _text("postcode", 4),
        _text("loyalty_program", 20, domain=LOYALTY_PROGRAMS, default="None"),
        Field("signup_date", "date"),
        Field("created_at", "timestamp_ntz", default=NOW),
    ),
    primary_key="customer_id",
    unique=("email",),
)

STORES = Table(
    "stores",
    (
        Field("store_id", "int"),
        _text("store_name", 100),
        _text("banner", 30, domain=sum(BANNERS_BY_GROUP.values(), ())),
        _text("parent_group", 30, domain=tuple(BANNERS_BY_GROUP)),
        _text("suburb", 100),
        _text("state", 3, domain=STATES),
        _text("postcode", 4),
        _text("region_type", 10, domain=REGION_TYPES, default="Metro"),
        Field("opened_date", "date", nullable=True),
    ),
    primary_key="store_id",
)

PRODUCTS = Table(
    "products",
    (
        Field("product_id", "int"),
        _text("product_name", 150),
        _text("category", 40, domain=CATEGORIES),
        _text("brand", 60),
        _text("unit_of_measure", 10, domain=UNITS, default="each"),
        Field("unit_price", "decimal(8,2)", floor="positive"),
    ),
    primary_key="product_id",
)

TRANSACTIONS = Table(
    "transactions",
    (
        Field("transaction_id", "bigint"),
        Field("customer_id", "int"),
        Field("store_id", "int"),
        Field("product_id", "int"),
        Field("transaction_date", "date"),
        Field("quantity", "int", floor="positive"),
        Field("unit_price", "decimal(8,2)", floor="positive"),
        Field("discount_amount", "decimal(8,2)", floor="not_negative", default=0),
        Field("amount", "decimal(10,2)", floor="positive"),
        _text("payment_method", 20, domain=PAYMENT_METHODS),
    ),
    primary_key="transaction_id",
    foreign_keys={
        "customer_id": ("customers", "customer_id"),
        "store_id": ("stores", "store_id"),
        "product_id": ("products", "product_id"),
    },
)

# Parents before children: the order to load in.
TABLES = {table.name: table for table in (CUSTOMERS, STORES, PRODUCTS, TRANSACTIONS)}


def conform(df: DataFrame | Joined, table: Table) -> DataFrame | Joined:
    """Select the table's columns by name, cast to its types.

    A column that is absent gets its default, or NULL where NULLs are allowed.
    Text dates and binary-float money, as simpler databases keep them, come out
    as DATE and DECIMAL. A table in two parts stays one.
    """
    missing = [
        f.name
        for f in table.fields
        if f.name not in df.columns and f.default is None and not f.nullable
    ]
    if missing:
        raise ValueError(f"{table.name} lacks {', '.join(missing)}")
    if isinstance(df, Joined):
        heads = [f for f in table.fields if f.name in df.heads.columns]
        lines = [f for f in table.fields if f not in heads]
        return Joined(
            df.lines.select(df.key, *_values(lines, df.columns)),
            df.heads.select(df.key, *_values(heads, df.columns)),
            df.key,
        )
    return df.select(_values(table.fields, df.columns))


def _values(fields, given: list[str]) -> list:
    return [_value(f, f.name in given).alias(f.name) for f in fields]


def _value(f: Field, present: bool):
    if present:
        value = F.col(f.name)
    elif f.default == NOW:
        value = F.current_timestamp()
    else:
        value = F.lit(f.default)
    return value.cast(f.type)
