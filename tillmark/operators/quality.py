"""Data-quality checks that report counts instead of stopping at the first failure.

Every check yields one row: check, table, column, rows_checked, violations,
passed. All row-level checks of a table share one scan. Checks across tables
shrink the large side by a grouping with map-side partial sums before it meets
the other table, so a key held by very many rows costs one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import as_of_date
from tillmark.functions.money import line_total
from tillmark.operators.joined import Joined
from tillmark.operators.lookup import lookup
from tillmark.session import cut_lineage
from tillmark.sources.contracts import (
    BANNERS_BY_GROUP,
    LINE_TOTAL_TOLERANCE,
    STATES,
    TABLES,
    Table,
)

@dataclass(frozen=True)
class RowCheck:
    """A condition that marks a bad row; NULL conditions pass, as in a CHECK constraint.

    With ``among`` only the rows that meet it count as checked. ``reads`` names the columns of both,
    if known: a table in two parts is then checked before they meet.
    """

    check: str
    column: str
    violation: Column
    among: Column | None = None
    reads: tuple[str, ...] | None = None


def _own(check: str, column: str, violation: Column) -> RowCheck:
    """A check that reads its column only."""
    return RowCheck(check, column, violation, reads=(column,))


def not_null(*columns: str) -> list[RowCheck]:
    return [_own("not_null", name, F.col(name).isNull()) for name in columns]


def positive(*columns: str) -> list[RowCheck]:
    return [_own("positive", name, F.col(name) <= 0) for name in columns]


def not_negative(*columns: str) -> list[RowCheck]:
    return [_own("not_negative", name, F.col(name) < 0) for name in columns]


def within_line_total(
    amount: str = "amount",
    quantity: str = "quantity",
    unit_price: str = "unit_price",
    tolerance: str = LINE_TOTAL_TOLERANCE,
) -> RowCheck:
    limit = line_total(F.col(quantity), F.col(unit_price)) + F.lit(tolerance).cast("decimal(8,2)")
    reads = (amount, quantity, unit_price)
    return RowCheck("within_line_total", amount, F.col(amount) > limit, reads=reads)


def in_domain(column: str, domain: Sequence) -> RowCheck:
    return _own("in_domain", column, ~F.col(column).isin(list(domain)))


def matches_group(column: str, group: str, members: Mapping[str, Sequence[str]]) -> RowCheck:
    """``column`` must be one of the values its ``group`` allows."""
    allowed = [
        F.col(column).isin(list(values)) & (F.col(group) == name)
        for name, values in members.items()
    ]
    return RowCheck("matches_group", f"{column}, {group}", ~reduce(Column.__or__, allowed))


def not_before(column: str, earliest: str) -> RowCheck:
    return RowCheck("not_before", f"{column}, {earliest}", F.col(column) < F.col(earliest))


def not_future(column: str, as_of=None) -> RowCheck:
    return _own("not_future", column, F.col(column) > as_of_date(as_of))


def max_length(column: str, length: int) -> RowCheck:
    return _own("max_length", column, F.char_length(column) > length)


def fits_numeric(column: str, precision: int, scale: int, text: bool = False) -> RowCheck:
    """The value must fit NUMERIC(precision, scale) after rounding to its scale.

    Numbers are compared with the smallest value that rounds out of range, which
    is far cheaper than a failing cast; ``text`` columns must also parse.
    """
    if text:
        cast = F.col(column).try_cast(f"decimal({precision},{scale})")
        return RowCheck("fits_numeric", column, cast.isNull() & F.col(column).isNotNull())
    limit = Decimal(10) ** (precision - scale) - Decimal(5).scaleb(-scale - 1)
    return RowCheck("fits_numeric", column, F.abs(column) >= F.lit(limit))


def check_rows(
    df: DataFrame, table: str, checks: Sequence[RowCheck], minimum: int | None = None
) -> DataFrame:
    """All checks of one table in a single aggregation over a single scan.

    With ``minimum`` the volume is checked by the same scan.
    """
    rows = F.count("*")
    lines = [("volume", "*", _missing(rows, minimum), rows)] if minimum is not None else []
    lines += [
        (
            c.check,
            c.column,
            F.count_if(c.violation),
            rows if c.among is None else F.count_if(c.among),
        )
        for c in checks
    ]
    counts = df.agg(
        *[line[2].alias(f"_v{i}") for i, line in enumerate(lines)],
        *[line[3].alias(f"_r{i}") for i, line in enumerate(lines)],
    )
    report = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(table).alias("table"),
                F.lit(column).alias("column"),
                F.col(f"_r{i}").alias("rows_checked"),
                F.col(f"_v{i}").alias("violations"),
            )
            for i, (check, column, *_) in enumerate(lines)
        ]
    )
    return counts.select(F.inline(report)).withColumn("passed", F.col("violations") == 0)


def violating_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """The rows that break any check, with the checks they break."""
    broken = F.array_compact(
        F.array(*[F.when(c.violation, F.lit(f"{c.check}({c.column})")) for c in checks])
    )
    return df.withColumn("broken_checks", broken).filter(F.size("broken_checks") > 0)


def check_volume(df: DataFrame, table: str, minimum: int = 1) -> DataFrame:
    """At least ``minimum`` rows; the violations are the rows that are missing."""
    return check_rows(df, table, [], minimum)


def check_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Total rows minus distinct keys; a key with a NULL never counts as distinct."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    complete = reduce(Column.__and__, [F.col(name).isNotNull() for name in keys])
    return _report(
        groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_checked"),
            F.coalesce(F.sum(F.when(complete, F.col("_n") - 1).otherwise(F.col("_n"))), F.lit(0))
            .alias("violations"),
        ),
        "unique",
        table,
        ", ".join(keys),
    )


def check_new_keys(df: DataFrame, table: str, key: str, stored: DataFrame) -> DataFrame:
    """Rows whose key is in the stored table already."""
    held = df.groupBy(key).agg(F.count("*").alias("_n"))
    old = stored.select(key).distinct().withColumn("_old", F.lit(True))
    return _report(
        held.join(old, key, "left").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_checked"),
            F.coalesce(F.sum(F.when(F.col("_old"), F.col("_n"))), F.lit(0)).alias("violations"),
        ),
        "new_key",
        table,
        key,
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Foreign keys without a parent and their row counts; NULL counts as an orphan."""
    held = child.groupBy(column).agg(F.count("*").alias("row_count"))
    return held.join(_keys(parent, parent_column, column), column, "left_anti")


def check_references(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose foreign key has no parent."""
    held = child.groupBy(column).agg(F.count("*").alias("_n"))
    known = _keys(parent, parent_column, column).distinct().withColumn("_known", F.lit(True))
    return _report(
        held.join(known, column, "left").agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_checked"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias(
                "violations"
            ),
        ),
        "references",
        table,
        column,
    )


def orphan_rows(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """The rows whose foreign key has no parent.

    The orphan keys are found first, one row each. The wide rows then only look
    those keys up: broadcast when they are few, as usual, salted when not. NULL
    keys never enter a join, where they would all hash to one task.
    """
    lost = orphan_keys(child, column, parent, parent_column).select(column)
    lost = cut_lineage(lost.filter(F.col(column).isNotNull()))
    unmatched = lookup(child.filter(F.col(column).isNotNull()), lost, [column], "left_semi")
    return child.filter(F.col(column).isNull()).unionByName(unmatched)


def check_date_order(
    child: DataFrame,
    table: str,
    column: str,
    child_date: str,
    parent: DataFrame,
    parent_column: str,
    parent_date: str,
) -> DataFrame:
    """Rows dated before their parent's date, among rows that have a parent.

    One shuffle of the child at most; a parent with many children is split by adaptive execution.
    """
    dated = parent.select(F.col(parent_column).alias(column), F.col(parent_date).alias("_start"))
    early = F.col(child_date) < F.col("_start")
    return _report(
        child.select(column, child_date)
        .join(dated, column)
        .agg(F.count("*").alias("rows_checked"), F.count_if(early).alias("violations")),
        "date_order",
        table,
        f"{child_date}, {parent_date}",
    )


def unexpected_values(df: DataFrame, column: str, domain: Iterable) -> DataFrame:
    """Values outside the domain, with their row counts; NULL is never unexpected."""
    outside = df.filter(~F.col(column).isin(list(domain)))
    return outside.groupBy(column).agg(F.count("*").alias("row_count"))


def all_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def failures(report: DataFrame) -> list[str]:
    """Failed checks as text; a report has one row per check."""
    bad = report.filter(~F.col("passed")).orderBy("table", "check", "column").collect()
    return [f"{r.table}.{r.column}: {r.check} broken by {r.violations} rows" for r in bad]


def contract_checks(table: Table, as_of=None) -> list[RowCheck]:
    """The row-level checks a table contract declares."""
    checks: list[RowCheck] = []
    for f in table.fields:
        if not f.nullable:
            checks += not_null(f.name)
        if f.max_length:
            checks.append(max_length(f.name, f.max_length))
        if f.domain:
            checks.append(in_domain(f.name, f.domain))
        if f.floor == "positive":
            checks += positive(f.name)
        elif f.floor == "not_negative":
            checks += not_negative(f.name)
    if table.name == "stores":
        checks.append(matches_group("banner", "parent_group", BANNERS_BY_GROUP))
    if table.name == "transactions":
        checks += [within_line_total(), not_future("transaction_date", as_of)]
    return checks


def check_key_references(
    child: DataFrame | Joined, table: str, parents: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """``check_references`` of several short-keyed columns in one scan of the child.

    ``parents`` maps a column to its parent and the parent's key.
    """
    known = {column: _keys(parent, own, column) for column, (parent, own) in parents.items()}
    return check_once(child, table, [], references=known)


@dataclass(frozen=True)
class Dated:
    """Rows must not be dated before the start of what their ``key`` names.

    ``starts`` has one row per key: key, rows (that have it), start, and more, an array of
    (start, rows) if these differ, else NULL. With ``known`` every key must be there, too.
    """

    key: str
    date: str
    column: str
    starts: DataFrame
    known: bool = False


def starts(parent: DataFrame, key: str, start: str) -> DataFrame:
    """What ``Dated`` needs of a parent whose keys may repeat."""
    held = parent.groupBy(key, start).agg(F.count("*").alias("_n"))
    dates = F.collect_list(F.struct(F.col(start).alias("start"), F.col("_n").alias("rows")))
    return held.groupBy(key).agg(
        F.sum("_n").alias("rows"),
        F.min(start).alias("start"),
        F.when(F.count("*") > 1, dates).alias("more"),
    )


def check_once(
    rows: DataFrame | Joined,
    table: str,
    checks: Sequence[RowCheck],
    minimum: int | None = None,
    unique: Sequence[str] = (),
    references: Mapping[str, DataFrame] | None = None,
    dated: Dated | None = None,
) -> DataFrame:
    """Checks of rows, unique keys, references and dates in one scan of a large table.

    What row checks find becomes one number per row, before the row meets anything else; of a table
    in two parts, in the part that has the columns. The dates are looked up for the part with their
    key. Then the numbers and keys are counted per task, and only distinct ones are shuffled, next
    to the keys of the parents (``references`` maps a column to a frame of them).
    """
    references = references or {}
    marks = [(c.violation, c.reads) for c in checks]
    marks += [(c.among, c.reads) for c in checks if c.among is not None]
    if len(marks) > 62:
        raise ValueError("at most 62 conditions fit a number")
    keys = [*unique, *references]
    needed = list(dict.fromkeys([*keys, *([dated.key, dated.date] if dated else [])]))
    frame = _marked(rows, marks, needed, dated)
    none = F.lit(0).cast("bigint")
    held, early = none, none
    if dated:
        day = F.col(dated.date)
        several = F.aggregate(
            F.filter("_more", lambda s: day < s["start"]), none, lambda n, s: n + s["rows"]
        )
        alike = F.when(day < F.col("_start"), F.col("_rows"))
        held = F.coalesce("_rows", none)
        early = F.coalesce(F.when(F.col("_more").isNull(), alike).otherwise(several), none)
    whole = {"tinyint", "smallint", "int", "bigint"}
    kinds = [dict(frame.dtypes)[name] for name in keys] + [p.dtypes[0][1] for p in references.values()]
    kind = "bigint" if set(kinds) <= whole else "string"

    def counted(number: int, key: Column, held: Column = none, early: Column = none) -> Column:
        return F.struct(
            F.lit(number).alias("kind"), key.cast(kind).alias("key"), held.alias("held"), early.alias("early")
        )

    seen = frame.select(
        F.inline(
            F.array(
                counted(0, F.col("_marks"), held, early),
                *[counted(i, F.col(name)) for i, name in enumerate(keys, 1)],
            )
        )
    ).withColumns({"rows": F.lit(1), "known": F.lit(False)})
    for i, parent in enumerate(references.values(), len(unique) + 1):
        own = parent.select(F.col(parent.columns[0])).toDF("key").filter(F.col("key").isNotNull())
        seen = seen.unionByName(
            own.select(F.inline(F.array(counted(i, F.col("key"))))).withColumns(
                {"rows": F.lit(0), "known": F.lit(True)}
            )
        )
    groups = seen.groupBy("kind", "key", "held", "early").agg(
        F.sum("rows").alias("rows"), F.max("known").alias("known")
    )

    def total(number: int, value: Column, when: Column | None = None) -> Column:
        own = F.col("kind") == number
        return F.coalesce(F.sum(F.when(own if when is None else own & when, value)), none)

    def marked(bit: int) -> Column:
        return total(0, n, F.col("key").cast("bigint").bitwiseAND(F.lit(1 << bit)) != 0)

    n = F.col("rows")
    every = total(0, n)
    lines = [("volume", "*", every, _missing(every, minimum))] if minimum is not None else []
    amongst = iter(range(len(checks), len(marks)))
    for bit, c in enumerate(checks):
        rows_checked = every if c.among is None else marked(next(amongst))
        lines.append((c.check, c.column, rows_checked, marked(bit)))
    for i, name in enumerate(unique, 1):
        distinct = total(i, F.lit(1), F.col("key").isNotNull() & (n > 0))
        lines.append(("unique", name, every, every - distinct))
    for i, name in enumerate(references, len(unique) + 1):
        lines.append(("references", name, every, total(i, n, ~F.col("known"))))
    if dated and dated.known:
        lines.append(("references", dated.key, every, total(0, n, F.col("held") == 0)))
    if dated:
        lines.append(
            ("date_order", dated.column, total(0, n * F.col("held")), total(0, n * F.col("early")))
        )
    counts = groups.agg(
        *[line[2].alias(f"_r{i}") for i, line in enumerate(lines)],
        *[line[3].alias(f"_v{i}") for i, line in enumerate(lines)],
    )
    report = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.col(f"_r{i}").cast("bigint").alias("rows_checked"),
            F.col(f"_v{i}").cast("bigint").alias("violations"),
        )
        for i, (check, column, *_) in enumerate(lines)
    ]
    return counts.select(F.inline(F.array(*report))).withColumn("passed", F.col("violations") == 0)


def _marked(
    rows: DataFrame | Joined,
    marks: Sequence[tuple[Column, tuple[str, ...] | None]],
    needed: Sequence[str],
    dated: Dated | None,
) -> DataFrame:
    """The needed columns, the conditions a row meets as bits of ``_marks``, and its ``Dated``."""

    def part(df: DataFrame, own: Sequence[str], bits: Sequence[int], name: str) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        met = [F.when(marks[bit][0], F.lit(1 << bit).cast("bigint")).otherwise(zero) for bit in bits]
        narrow = df.select(*own, reduce(Column.bitwiseOR, met, zero).alias(name))
        if dated is None or dated.key not in own:
            return narrow
        at = dated.starts.select(
            F.col(dated.key), *[F.col(c).alias(f"_{c}") for c in ("rows", "start", "more")]
        )
        return narrow.join(at, dated.key, "left")

    if not isinstance(rows, Joined):
        return part(rows, needed, range(len(marks)), "_marks")

    def inside(df: DataFrame) -> list[int]:
        return [i for i, (_, reads) in enumerate(marks) if reads and set(reads) <= set(df.columns)]

    on_heads = inside(rows.heads)
    on_lines = [bit for bit in inside(rows.lines) if bit not in on_heads]
    if len(on_lines) + len(on_heads) < len(marks):
        return part(rows.rows(), needed, range(len(marks)), "_marks")
    of_heads = [name for name in needed if name in rows.heads.columns]
    of_lines = [name for name in needed if name not in of_heads]
    heads = part(rows.heads, [rows.key, *of_heads], on_heads, "_head_marks")
    lines = part(rows.lines, [rows.key, *of_lines], on_lines, "_line_marks")
    met = F.col("_line_marks").bitwiseOR(F.col("_head_marks"))
    return lines.join(heads, rows.key).withColumn("_marks", met)


def castable(table: Table, df: DataFrame) -> list[RowCheck]:
    """For each column of a contract that ``df`` has: its values convert to the declared type."""
    return [
        RowCheck(
            "castable",
            f.name,
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.type).isNull(),
        )
        for f in table.fields
        if f.name in df.columns
    ]


def check_tables(
    frames: Mapping[str, DataFrame | Joined],
    as_of=None,
    minimum_transactions: int = 1,
    stored: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Every contract check of the given tables, in one report.

    References are checked against the parents that are given, together with the rows that are
    ``stored`` already; new keys must also differ from the stored ones. A table with references is
    scanned once for all its checks but those of new keys.
    """
    stored = stored or {}
    reports = []
    for name, frame in frames.items():
        table = TABLES[name]
        minimum = minimum_transactions if name == "transactions" else 1
        keys = (table.primary_key, *table.unique)
        checks = contract_checks(table, as_of)
        if table.foreign_keys:
            known = {
                column: [t[parent].select(own) for t in (frames, stored) if parent in t]
                for column, (parent, own) in table.foreign_keys.items()
            }
            parents = {column: reduce(DataFrame.union, own) for column, own in known.items() if own}
            dated = None
            if name == "transactions" and "customers" in frames:
                dated = Dated(
                    "customer_id",
                    "transaction_date",
                    "transaction_date, signup_date",
                    starts(frames["customers"], "customer_id", "signup_date"),
                    known="customers" not in stored,
                )
                if dated.known:
                    del parents["customer_id"]
            reports.append(check_once(frame, name, checks, minimum, keys, parents, dated))
        else:
            reports.append(check_rows(frame, name, checks, minimum))
            reports += [check_unique(frame, name, [key]) for key in keys]
        if name in stored:
            own = frame.rows() if isinstance(frame, Joined) else frame
            reports += [check_new_keys(own, name, key, stored[name]) for key in keys]
    return all_reports(reports)


def integrity_suite(
    frames: Mapping[str, DataFrame | Joined],
    as_of=None,
    minimum_transactions: int = 10_000,
    states: Sequence[str] = STATES,
) -> DataFrame:
    """The standing integrity checks of a loaded database, as one report.

    All four tables must be given; columns no check reads may be absent. The transactions are
    scanned once.
    """
    sales, customers = frames["transactions"], frames["customers"]
    sales_checks = [
        *not_null("customer_id", "store_id", "product_id", "amount", "transaction_date"),
        *positive("amount", "unit_price", "quantity"),
        within_line_total(),
        not_future("transaction_date", as_of),
    ]
    dates = F.array().cast("array<struct<start:date,rows:bigint>>")
    signups = customers.groupBy("customer_id").agg(
        F.lit(1).cast("bigint").alias("rows"),
        F.min("signup_date").alias("start"),
        F.when(F.lit(False), dates).alias("more"),
    )
    dated = Dated(
        "customer_id", "transaction_date", "transaction_date, signup_date", signups, known=True
    )
    others = {
        column: _keys(frames[parent], key, column)
        for column, (parent, key) in TABLES["transactions"].foreign_keys.items()
        if column != "customer_id"
    }
    return all_reports(
        [
            check_once(
                sales,
                "transactions",
                sales_checks,
                minimum_transactions,
                references=others,
                dated=dated,
            ),
            check_rows(customers, "customers", [in_domain("state", states)], 1),
            check_volume(frames["stores"], "stores"),
            check_volume(frames["products"], "products"),
            check_unique(customers, "customers", ["email"]),
        ]
    )


def _missing(rows: Column, minimum: int) -> Column:
    return F.greatest(F.lit(minimum) - rows, F.lit(0)).cast("bigint")


def _keys(parent: DataFrame, parent_column: str, column: str) -> DataFrame:
    return parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())


def _report(counts: DataFrame, check: str, table: str, column: str) -> DataFrame:
    return counts.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.col("rows_checked").cast("bigint").alias("rows_checked"),
        F.col("violations").cast("bigint").alias("violations"),
        (F.col("violations") == 0).alias("passed"),
    )
