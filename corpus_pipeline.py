"""A training corpus from raw documents, in five stages.

Each stage works on all that the one before kept; its result is written to the
shared folder as Parquet and read again. All stages but the last return the
columns of `documents`; the last returns a row per document from the token
files it wrote.

The stages share the executors' Python workers, so each of them sets the bytes
of a batch of rows, `BATCH_BYTES`, in the session: by default a batch has 10,000
texts of any length, and both sides hold several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import decontaminate, mixing, quality, simhash, token_files
from wayfare.llm.common import table
from wayfare.llm.queries import vocabulary
from wayfare.session import new_run_dir, store

BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """A setting of the session, since a stage's result is computed after the stage returns."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line labels keep."""
    small_batches(spark)
    return quality.keep_content(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked fingerprints, the one with the smallest id."""
    small_batches(spark)
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files with a seek table, read back: a row per document."""
    small_batches(spark)
    return token_files.token_files(docs, vocabulary)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("token files", token_output),
]

# A trained chain, 64-bit hashes and a tokenizer: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"{folder}/{i}")
    return docs
