"""Session settings and lineage cuts."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Bytes of rows that go to a Python worker at once, or one row. Both sides hold whole batches, and
# Spark's own bound of 64 MB (or 10,000 rows) counts for every task and every step of one.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = "4m"


def build_session(
    app_name: str = "tillmark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """A session with the settings the operators are written for.

    ``shuffle_partitions`` is the number adaptive execution starts from and can only lower: for
    large data, the bytes of the largest shuffle over some 200 MB.

    Adaptive execution is what coalesces small shuffles, splits skewed join
    partitions and swaps sort-merge for broadcast joins at run time.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Recording the call site of every expression doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        BATCH_SETTING: BATCH,
        **(conf or {}),
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the session names; pick a scratch one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif re.match(r"local(\[|$)", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillmark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def ensure_small_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch for Python, unless the session names a bound."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder.

    Later reads come from files that outlive any executor, so values that
    depend on one particular execution (partition ids, range bounds) stay put,
    and an expensive scan below is never repeated.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
