"""Run registered queries and their SQL twins on the same Parquet tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def bag(df) -> list[tuple]:
    return sorted([tuple(row) for row in df.collect()], key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(folder, f"{name}.parquet").exists():
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    """What differs: columns, row count, values (as bags of rows)."""
    twin = connection.sql(sql)
    names = sorted(df.columns)
    if names != sorted(twin.columns):
        return [f"columns {names} and {sorted(twin.columns)}"]
    ours = Counter(tuple(row[name] for name in names) for row in df.collect())
    theirs = Counter(
        connection.sql(
            "SELECT " + ", ".join(f'"{name}"' for name in names) + f" FROM ({sql})"
        ).fetchall()
    )
    found = []
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    same = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "date": "DATE",
        "boolean": "BOOLEAN",
    }
    for name, kind in zip(twin.columns, twin.types):
        if same.get(kinds[name]) != str(kind):
            found.append(f"type of {name}: {kinds[name]} and {kind}")
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
        found.append(f"rows {ours.total()} and {theirs.total()}: {only_ours[:3]} {only_theirs[:3]}")
    return found
