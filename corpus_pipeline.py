"""A training corpus from raw documents: classify, remove lines and near-duplicates, mask secrets, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's documents. All but the last return
the columns of documents; a stage works on all rows that the one before it kept.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sitewright.llm import op01_simhash, op04_lines, op06_quality_cnn, op07_secrets, op10_packing
from sitewright.llm.common import table
from sitewright.sources.files import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents that go to Python at a time. Executors hold a batch several times over, on both sides.
BATCH = 1_000


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    _in_small_batches(spark)
    return op06_quality_cnn.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, of every group of near-equal lines only the first."""
    return op04_lines.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: five-word shingles, a similarity of 0.8 or more."""
    _in_small_batches(spark)
    return op01_simhash.representatives(docs, op01_simhash.near_copies(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return op07_secrets.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids, and their places in sequences."""
    _in_small_batches(spark)
    return op10_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("best_fit_packing", packing),
]

#: The stages use trained models, tokenizers and hashes that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
