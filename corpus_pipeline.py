"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

1. Documents that the toxicity model rejects go.
2. One document of each group of near duplicates stays.
3. Documents contaminated with benchmark items go.
4. Personal data in the texts is replaced by its kind.
5. The texts are encoded, decoded again, and listed with their digests.

Edge cases are those of the operators; a stage without rows gives an empty table to the next one.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tillmark.llm import bpe, decontam, jaccard, pii, toxicity
from tillmark.llm.frames import table
from tillmark.llm.queries import tokenizer_path
from tillmark.session import ensure_checkpoint_dir


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_per_group(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs, pii.learn(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(docs, tokenizer_path()))


STAGES = [
    ("toxicity", clean),
    ("near_duplicates", distinct),
    ("decontamination", unseen),
    ("personal_data", private),
    ("tokens", tokens),
]

# Training and merging cannot be said in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Stages are written to the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
