"""Reading and loading tables: Parquet folders, the session catalog, JDBC databases."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote, urlsplit
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.dates import month_start
from tillmark.operators.quality import all_reports, castable, check_rows, check_tables, failures
from tillmark.sources.contracts import NOW, TABLES, Field, Table, conform

DEFAULT_LOCATION = "retail_data"
CATALOG = "catalog:"
MONTH = "transaction_month"
# Below a folder: what loads have written, and which of it counts.
LOADS, LOG = "loads", "load_log"
LOG_SCHEMA = "number long, part int, name string, begins boolean, folder string"
BUCKETED_BY = "customer_id"
PARTS = "load.parts"  # the property of a view that lists the tables under it


class FailedChecks(ValueError):
    """Raised instead of loading tables that break their contracts."""


def table_location(location: str | None = None) -> str:
    """The given location, else ``$DATABASE_URL``, else a local Parquet folder.

    ``scheme://`` database URLs and ``jdbc:`` URLs mean a database,
    ``catalog:<schema>`` the session catalog, anything else a Parquet folder.
    """
    return location or os.environ.get("DATABASE_URL") or DEFAULT_LOCATION


def jdbc_options(location: str) -> dict[str, str] | None:
    """JDBC options of a database URL, or None when it is not one.

    The driver's jar must be on Spark's class path.
    """
    if location.startswith("jdbc:"):
        return {"url": location}
    parts = urlsplit(location)
    kind = parts.scheme.split("+")[0]
    if kind == "sqlite":
        return {"url": f"jdbc:sqlite:{parts.path[1:]}"}
    if kind not in ("postgresql", "postgres"):
        return None
    host = parts.hostname or "localhost"
    if ":" in host:
        host = f"[{host}]"
    port = f":{parts.port}" if parts.port else ""
    query = f"?{parts.query}" if parts.query else ""
    options = {"url": f"jdbc:postgresql://{host}{port}{parts.path}{query}"}
    if parts.username:
        options["user"] = unquote(parts.username)
    if parts.password:
        options["password"] = unquote(parts.password)
    return options


def split_options(column: str, lowest: int, highest: int, connections: int) -> dict[str, str]:
    """JDBC options that read ranges of an integer column over several connections."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lowest),
        "upperBound": str(highest + 1),
        "numPartitions": str(max(1, min(connections, highest - lowest + 1))),
    }


def read_table(
    spark: SparkSession,
    table: Table,
    location: str | None = None,
    connections: int | None = None,
) -> DataFrame:
    """One contract table from a location.

    A database table is read in ranges of its primary key, by as many
    connections as the session has cores unless told otherwise, so that no
    single task has to pull the whole table.
    """
    place = table_location(location)
    options = jdbc_options(place)
    if options:
        reader = spark.read.format("jdbc").options(**options)
        key = table.primary_key
        ends = (
            reader.option("query", f"SELECT MIN({key}), MAX({key}) FROM {table.name}")
            .load()
            .first()
        )
        reader = spark.read.format("jdbc").options(**options).option("dbtable", table.name)
        if ends[0] is not None:
            wanted = connections or spark.sparkContext.defaultParallelism
            reader = reader.options(**split_options(key, int(ends[0]), int(ends[1]), wanted))
        found = reader.load()
    elif place.startswith(CATALOG):
        found = spark.table(_catalog_name(place, table.name))
    else:
        found = spark.read.parquet(*_live_folders(spark, place, table.name))
    return conform(found, table)


def read_tables(spark: SparkSession, location: str | None = None) -> dict[str, DataFrame]:
    return {name: read_table(spark, table, location) for name, table in TABLES.items()}


def load_tables(
    frames: Mapping[str, DataFrame],
    location: str | None = None,
    mode: str = "append",
    checked: bool = True,
    as_of=None,
    buckets: int | None = None,
) -> None:
    """Write tables, parents first, columns matched by name and defaults filled in.

    ``mode`` is "append" or "overwrite" (a full refresh). With ``checked`` the
    contracts are checked first and nothing is written when one is broken: values
    must convert to the declared types, references need a parent that is given or
    stored, and appended keys must be new.

    In folders and catalogs a load is all or nothing: every table is written to a
    place of its own, and what readers see changes only after the last one is
    written. Nothing is deleted, so whoever reads the old state goes on reading it.
    A database gets one table after the other. One loader at a time.

    With ``buckets``, a catalog keeps customers and transactions in so many buckets by customer,
    sorted inside: after one load, groupings and joins by customer need no shuffle of either. Rows
    that several loads have appended are shuffled again.
    """
    if buckets and not table_location(location).startswith(CATALOG):
        raise ValueError("only catalog tables can be bucketed")
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    place = table_location(location)
    given = {name: table for name, table in TABLES.items() if name in frames}
    if checked and given:
        _refuse(
            all_reports(
                [check_rows(frames[n], n, castable(table, frames[n])) for n, table in given.items()]
            )
        )
    ready = {name: conform(frames[name], table) for name, table in given.items()}
    if checked and given:
        spark = next(iter(ready.values())).sparkSession
        needed = {parent for table in given.values() for parent, _ in table.foreign_keys.values()}
        # A table that is replaced counts as given only.
        read = needed - set(given) if mode == "overwrite" else needed | set(given)
        stored = {name: read_table(spark, TABLES[name], place) for name in sorted(read)
                  if is_stored(spark, name, place)}
        lost = [
            f"{name}.{column}: references {parent}, which is neither given nor stored"
            for name, table in given.items()
            for column, (parent, _) in table.foreign_keys.items()
            if parent not in ready and parent not in stored
        ]
        if lost:
            raise FailedChecks("; ".join(lost))
        _refuse(check_tables(ready, as_of=as_of, stored=stored))
    options = jdbc_options(place)
    if options:
        for name, frame in ready.items():
            writer = frame.write.format("jdbc").options(**options).option("dbtable", name)
            # Keeps the database's own table definition on a refresh.
            writer.option("truncate", "true").mode(mode).save()
    elif place.startswith(CATALOG):
        _load_catalog(ready, place, mode, buckets)
    else:
        _load_folder(ready, place, mode)


def _load_folder(ready: Mapping[str, DataFrame], place: str, mode: str) -> None:
    """Write each table to a fresh folder, then add one file to the log that names them all.

    The log is a JSON table with a line per table and load; a single task appends a load's lines,
    so they appear together or not at all.
    """
    if not ready:
        return
    spark = next(iter(ready.values())).sparkSession
    number = max((line["number"] for line in _log(spark, place)), default=0) + 1
    lines = []
    for name, frame in ready.items():
        folder = f"{LOADS}/{number}-{uuid4().hex}/{name}"
        frame.write.parquet(os.path.join(place, folder))
        own = [folder]
        if mode == "append" and not _folders(_log(spark, place), name) and _is_folder(spark, place, name):
            own = [name, folder]  # a plain folder from before the first load
        for part, each in enumerate(own):
            begins = part == 0 and (mode == "overwrite" or len(own) == 2)
            lines.append((number, part, name, begins, each))
    spark.createDataFrame(lines, LOG_SCHEMA).coalesce(1).write.mode("append").json(
        os.path.join(place, LOG)
    )


def _log(spark: SparkSession, place: str) -> list:
    """The lines of the load log, oldest first: some words per load and table."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(os.path.join(place, LOG))
        return log.orderBy("number", "part").collect()
    except AnalysisException:
        return []


def _folders(log: list, name: str) -> list[str]:
    """The folders that hold a table now; a load that begins anew leaves the earlier ones out."""
    folders: list[str] = []
    for line in log:
        if line["name"] == name:
            folders = [*([] if line["begins"] else folders), line["folder"]]
    return folders


def _live_folders(spark: SparkSession, place: str, name: str) -> list[str]:
    found = _folders(_log(spark, place), name) or [name]
    return [os.path.join(place, folder) for folder in found]


def _is_folder(spark: SparkSession, place: str, name: str) -> bool:
    try:
        spark.read.parquet(os.path.join(place, name))
    except AnalysisException:
        return False
    return True


def _load_catalog(
    ready: Mapping[str, DataFrame], place: str, mode: str, buckets: int | None = None
) -> None:
    """Write each table to a fresh one, then point the views of their names at the fresh ones.

    Until the last table is written only tables of new names have come about. A table that is not
    a view yet keeps its rows under a new name.
    """
    written = {}
    for name, frame in ready.items():
        fresh = f"{_catalog_name(place, name)}__{uuid4().hex}"
        writer = frame.write
        if buckets and BUCKETED_BY in frame.columns:
            # One file per bucket: the rows are dealt as the buckets are.
            writer = frame.repartition(buckets, BUCKETED_BY).write
            writer = writer.bucketBy(buckets, BUCKETED_BY).sortBy(BUCKETED_BY)
        writer.saveAsTable(fresh)
        written[name] = (frame.sparkSession, fresh)
    for name, (spark, fresh) in written.items():
        view = _catalog_name(place, name)
        parts = [fresh]
        if spark.catalog.tableExists(view):
            if not _is_view(spark, view):
                kept = f"{view}__{uuid4().hex}"
                spark.sql(f"ALTER TABLE {view} RENAME TO {kept}")
                earlier = [kept]
            else:
                earlier = spark.sql(f"SHOW TBLPROPERTIES {view} ('{PARTS}')").first()["value"].split(",")
            parts = [*earlier, fresh] if mode == "append" else parts
        rows = " UNION ALL ".join(f"SELECT * FROM {part}" for part in parts)
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{PARTS}' = '{','.join(parts)}') AS {rows}"
        )


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _refuse(report: DataFrame) -> None:
    broken = failures(report)
    if broken:
        raise FailedChecks("; ".join(broken))


def is_stored(spark: SparkSession, name: str, location: str | None = None) -> bool:
    """Whether the location holds the table; a database is taken to hold all of them."""
    place = table_location(location)
    if jdbc_options(place):
        return True
    if place.startswith(CATALOG):
        return spark.catalog.tableExists(_catalog_name(place, name))
    return bool(_folders(_log(spark, place), name)) or _is_folder(spark, place, name)


def create_tables(spark: SparkSession, location: str = CATALOG) -> None:
    """Drop the four catalog tables, children first, and create them empty.

    Spark enforces the lengths and fills the defaults of such tables; all other
    rules are left to ``check_tables``.
    """
    names = {name: _catalog_name(location, name) for name in TABLES}
    for name in reversed(names):
        kind = "TABLE"
        if spark.catalog.tableExists(names[name]) and _is_view(spark, names[name]):
            kind = "VIEW"
        spark.sql(f"DROP {kind} IF EXISTS {names[name]}")
    for name, table in TABLES.items():
        columns = ", ".join(_column_ddl(f) for f in table.fields)
        spark.sql(f"CREATE TABLE {names[name]} ({columns}) USING parquet")


def save_by_month(transactions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Keep transactions in one folder per month, ordered by customer inside a file.

    Takes the place of indexes on date and customer: date filters prune folders,
    customer filters prune row groups. The rebalance splits a month that holds
    most of the rows over several tasks and merges small months into one.
    """
    month = month_start(F.col("transaction_date"))
    (
        transactions.withColumn(MONTH, month)
        .hint("rebalance", MONTH)
        .sortWithinPartitions(MONTH, "customer_id", "transaction_date")
        .write.mode(mode)
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Transactions from ``first`` to ``last`` (both included) of ``save_by_month``."""
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    return (
        spark.read.parquet(path)
        .filter(F.col(MONTH).between(month_start(start), month_start(end)))
        .filter(F.col("transaction_date").between(start, end))
        .drop(MONTH)
    )


def literal_table(spark: SparkSession, rows: Sequence[tuple], table: Table) -> DataFrame:
    """A short table from literal rows whose first column is numbered from 1."""
    names = [f.name for f in table.fields]
    numbered = [(number, *row) for number, row in enumerate(rows, start=1)]
    return conform(spark.createDataFrame(numbered, names[: len(numbered[0])]), table)


def load_summary(frames: Mapping[str, DataFrame], amount: str = "amount") -> DataFrame:
    """Rows per table, and the sum of ``amount`` where a table has it."""
    parts = []
    for name, frame in frames.items():
        total = F.sum(amount) if amount in frame.columns else F.lit(None)
        parts.append(
            frame.agg(
                F.lit(name).alias("table"),
                F.count("*").alias("row_count"),
                total.cast("decimal(38,2)").alias("total_revenue"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def probe(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table has a row, reading no more than one of each."""
    return reduce(
        DataFrame.unionByName,
        [
            frame.limit(1).agg(F.lit(name).alias("table"), (F.count("*") > 0).alias("has_rows"))
            for name, frame in frames.items()
        ],
    )


def scalar(df: DataFrame):
    """The single value of a result that must have exactly one row."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row, found {'none' if not rows else 'more'}")
    return rows[0][0]


def _column_ddl(f: Field) -> str:
    kind = f"VARCHAR({f.max_length})" if f.max_length else f.type
    if f.default is None:
        return f"{f.name} {kind}"
    value = "localtimestamp()" if f.default == NOW else repr(f.default)
    return f"{f.name} {kind} DEFAULT {value}"


def _catalog_name(place: str, name: str) -> str:
    schema = place[len(CATALOG) :]
    return f"{schema}.{name}" if schema else name
