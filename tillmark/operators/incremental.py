"""Row checks of a growing folder that read every file once.

Counts of rows and violations add up, so they are kept per file in a small state table; a later
check reads only files that came or changed since, and sums the states of the files that are there.
Checks that compare rows with other rows (keys, references) do not add up and are not for this.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.quality import RowCheck

FILE = ["file", "size", "modified"]
_STATE = (
    "rules string, file string, size long, modified timestamp, number int, rows long, violations long"
)


def incremental_report(
    spark: SparkSession,
    folder: str,
    state: str,
    table: str,
    checks: Sequence[RowCheck],
    minimum: int = 1,
) -> tuple[DataFrame, list[str]]:
    """The report of ``check_rows`` over the Parquet files of a folder, and the files read for it.

    ``state`` is a folder of its own; the first run fills it. A file counts as known by its path, size
    and time of change, and only under the same checks: other checks read everything anew. Checks
    must not depend on the day they run on.
    """
    rules = hashlib.sha256(
        "\n".join(f"{c.check}|{c.column}|{c.violation}|{c.among}" for c in checks).encode()
    ).hexdigest()
    files = _files(spark, folder)
    new = files.join(_known(spark, state, rules), FILE, "left_anti").select("file").collect()
    paths = sorted(row["file"] for row in new)
    if paths:
        _counted(spark, folder, paths, checks, rules).write.mode("append").parquet(state)
    live = _known(spark, state, rules).join(files, FILE, "left_semi")
    sums = live.groupBy("number").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("bad"))
    names = [("volume", "*"), *[(c.check, c.column) for c in checks]]
    lines = spark.createDataFrame(
        [(i, check, table, column) for i, (check, column) in enumerate(names)],
        "number int, check string, table string, column string",
    )
    rows = F.coalesce("rows", F.lit(0).cast("long"))
    lacking = F.greatest(F.lit(minimum) - rows, F.lit(0)).cast("long")
    bad = F.when(F.col("number") == 0, lacking).otherwise(F.coalesce("bad", F.lit(0).cast("long")))
    report = lines.join(F.broadcast(sums), "number", "left").select(
        "check", "table", "column", rows.alias("rows_checked"), bad.alias("violations")
    )
    return report.withColumn("passed", F.col("violations") == 0), paths


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet files below a folder, from its listing; no file is opened."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
    )
    return listed.select(*_file_columns())


def _file_columns() -> list:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]


def _known(spark: SparkSession, state: str, rules: str) -> DataFrame:
    try:
        found = spark.read.schema(_STATE).parquet(state)
    except AnalysisException:
        found = spark.createDataFrame([], _STATE)
    return found.filter(F.col("rules") == rules).dropDuplicates([*FILE, "number"])


def _counted(
    spark: SparkSession, folder: str, paths: list[str], checks: Sequence[RowCheck], rules: str
) -> DataFrame:
    """The state of new files: a line per file and check, the first for the number of rows."""
    rows = F.count("*")
    counts = [F.struct(F.lit(0).alias("number"), rows.alias("rows"), (rows * 0).alias("violations"))]
    counts += [
        F.struct(
            F.lit(number).alias("number"),
            (rows if c.among is None else F.count_if(c.among)).alias("rows"),
            F.count_if(c.violation).alias("violations"),
        )
        for number, c in enumerate(checks, 1)
    ]
    reader = spark.read
    if os.path.basename(paths[0]) != os.path.basename(folder.rstrip("/")):
        reader = reader.option("basePath", folder)  # not where the folder is a single file
    return (
        reader.parquet(*paths)
        .select("*", *_file_columns())
        .groupBy(*FILE)
        .agg(F.array(*counts).alias("counts"))
        .select(F.lit(rules).alias("rules"), *FILE, F.inline("counts"))
    )
