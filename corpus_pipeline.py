"""From raw documents to token ids: quality, near duplicates, benchmark leaks, secrets, encoding.

Every stage takes (spark, documents, folder of the tables) and gives a DataFrame; all but the
last give the columns of ``documents``. A stage's result is written as Parquet and read again
as the next one's documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from granary.llm import bpe, decontaminate, quality, secrets, simhash  # noqa: E402
from granary.llm.common import SMALL_ROWS, table  # noqa: E402
from granary.session import durable, ship  # noqa: E402

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def ready(spark: SparkSession) -> SparkSession:
    """``spark`` with the package at its workers; long texts go to Python few at a time, as a batch is held on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SMALL_ROWS))
    return ship(spark)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(ready(spark), sf_dir, "labels"))


def single_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ready(spark)
    return simhash.keep_one(docs)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold passages of the benchmark."""
    return decontaminate.clean(docs, table(ready(spark), sf_dir, "benchmark"))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced, and n_chars of the new texts."""
    ready(spark)
    redacted = secrets.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else redacted


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number, and whether they decode to the text."""
    ready(spark)
    made = bpe.encode_and_verify(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return made.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "decodes")


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", single_documents),
    ("benchmark decontamination", unseen_documents),
    ("secret scans", redacted_documents),
    ("byte-level BPE encoding and decoding", encoded_documents),
]

#: The classifier and the near-duplicate stage have no SQL; brute-force versions test them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
