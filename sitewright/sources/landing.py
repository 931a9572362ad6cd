"""Landed batches: raw listings as JSON Lines under year=/month=/day=, and their manifest.

An ingestion has a folder of its own in its day, named by its time and
fingerprint, so that it can be read alone and a repeated one replaces itself.
The manifest is kept outside the dataset's folder, next to it.
"""

import logging
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.text import digest32
from sitewright.operators.parts import first_by
from sitewright.operators.runs import newest
from sitewright.schema import (
    LANDING_PARTITIONS,
    LISTING_COLUMNS,
    LISTING_SCHEMA,
    MANIFEST_SCHEMA,
    PER_PAGE,
    empty_table,
)
from sitewright.sources import files, versions

log = logging.getLogger(__name__)

AS_TEXT = ", ".join(f"`{name}` STRING" for name in LISTING_COLUMNS)


def dated(df: DataFrame, at: datetime | Column) -> DataFrame:
    """Rows with the partition columns of their landing time."""
    at = at if isinstance(at, Column) else F.lit(at.isoformat()).cast("timestamp_ntz")
    return df.withColumns(
        {
            "year": F.date_format(at, "yyyy"),
            "month": F.date_format(at, "MM"),
            "day": F.date_format(at, "dd"),
        }
    )


def land_batch(
    df: DataFrame, base: str, at: datetime | Column, clean_before_run: bool = False
) -> None:
    """Add a batch to the landed data, or replace all of it with the batch.

    `at` is the landing time, or a column when a backfill lands many days at
    once. Days are rebalanced, so that a large one is written by many tasks and
    small ones do not leave a file per task. What is replaced goes when the
    batch is written.
    """
    days = dated(df, at).hint("rebalance", *LANDING_PARTITIONS)

    def to(where: str) -> None:
        days.write.mode("append").partitionBy(*LANDING_PARTITIONS).option("ignoreNullFields", "false").json(where)

    if clean_before_run:
        versions.replace(df.sparkSession, base, to, keep=1)
    else:
        to(versions.current(df.sparkSession, base))


def _read(spark: SparkSession, base: str, arrays: bool, schema: str | None = None) -> DataFrame:
    # multiLine is only for files that hold one array; on JSON Lines it would
    # keep the first record of each file.
    where = versions.current(spark, base)
    reader = spark.read.option("basePath", where).option("multiLine", str(arrays).lower())
    return (reader.schema(schema) if schema else reader).json(f"{where}/year=*")


def on_date(df: DataFrame, date: dict[str, int] | None) -> DataFrame:
    """Rows of a landing date; any of year, month and day may be left out."""
    for part, value in (date or {}).items():
        df = df.where(F.col(part) == value)
    return df


def read_landed(
    spark: SparkSession, base: str, date: dict[str, int] | None = None, arrays: bool = False
) -> DataFrame:
    """Every landed record, with the columns found in the files."""
    return on_date(_read(spark, base, arrays), date)


def read_landed_listings(
    spark: SparkSession, base: str, date: dict[str, int] | None = None, arrays: bool = False
) -> DataFrame:
    """Landed records under the declared schema, with their partition columns.

    Coordinates are read as text and then cast, so quoted ones are kept.
    """
    parts = ", ".join(f"{name} INT" for name in LANDING_PARTITIONS)
    return _typed(on_date(_read(spark, base, arrays, f"{AS_TEXT}, {parts}"), date))


def _typed(raw: DataFrame) -> DataFrame:
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in LISTING_SCHEMA}
    return raw.select(
        *[c.alias(name) for name, c in cast.items()],
        *[c for c in LANDING_PARTITIONS if c in raw.columns],
    )


def read_batch(spark: SparkSession, path: str, arrays: bool = False) -> DataFrame:
    """The records of one ingestion only, by its path in the manifest, or of one file, under the declared schema."""
    reader = spark.read.option("multiLine", str(arrays).lower())
    return _typed(reader.schema(AS_TEXT).json(path))


def union_batches(*batches: DataFrame) -> DataFrame:
    """All records of all batches; a column that a batch lacks is null there."""
    result = batches[0]
    for batch in batches[1:]:
        result = result.unionByName(batch, allowMissingColumns=True)
    return result


# ---- fingerprint and manifest -----------------------------------------------


def batch_fingerprint(df: DataFrame) -> DataFrame:
    """Eight hex digits that stand for the batch as a bag of rows, and its row count.

    Row digests are added up, so neither row order nor layout matters and
    nothing is collected; columns enter by name.
    """
    total = F.coalesce(F.sum(digest32(*sorted(df.columns))), F.lit(0))
    digits = F.lower(F.lpad(F.hex(F.pmod(total, F.lit(2**32)).cast("long")), 8, "0"))
    return df.agg(digits.alias("fingerprint"), F.count(F.lit(1)).alias("total_records"))


def manifest_row(
    df: DataFrame,
    at: datetime,
    path: str,
    source: str,
    per_page: int = PER_PAGE,
    file_size_bytes: int = 0,
) -> DataFrame:
    """What is recorded about one batch. An empty batch is a warning, not a success."""
    counted = df.agg(F.count(F.lit(1)).alias("total_records"))
    return _manifest_of(counted, at, path, source, per_page, file_size_bytes)


def _manifest_of(
    counted: DataFrame, at: datetime, path: str, source: str, per_page: int, file_size_bytes: int, failed: bool = False
) -> DataFrame:
    records = F.col("total_records")
    return counted.select(
        F.md5(F.lit(f"{at.isoformat()}{path}")).alias("ingestion_id"),
        F.lit(at.isoformat()).alias("ingestion_timestamp"),
        F.lit(source).alias("source"),
        records,
        F.lit(path).alias("file_path"),
        F.lit(file_size_bytes).cast("long").alias("file_size_bytes"),
        F.struct(
            F.lit(at.year).alias("year"), F.lit(at.month).alias("month"), F.lit(at.day).alias("day")
        ).alias("partition_date"),
        F.lit("failed").alias("status") if failed else F.when(records > 0, "success").otherwise("warning").alias("status"),
        F.ceil(records / per_page).alias("pages_processed"),
    )


def append_manifest(row: DataFrame, manifest: str, clean_before_run: bool = False) -> None:
    def to(where: str) -> None:
        row.write.mode("append").json(where)

    if clean_before_run:
        versions.replace(row.sparkSession, manifest, to, keep=1)
    else:
        to(versions.current(row.sparkSession, manifest))


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """One row per ingestion; of one that was recorded again, the row with most records."""
    where = versions.current(spark, manifest)
    if not files.exists(spark, where):
        return empty_table(spark, MANIFEST_SCHEMA)
    return first_by(spark.read.schema(MANIFEST_SCHEMA).json(where), ["ingestion_id"], -F.col("total_records"))


def list_ingestions(manifest: DataFrame, limit: int | None = None) -> DataFrame:
    """Manifest rows, newest first."""
    return newest(manifest, limit, "ingestion_timestamp")


def latest_ingestion(manifest: DataFrame) -> DataFrame:
    """The newest manifest row; no row if nothing was ingested."""
    return newest(manifest, 1, "ingestion_timestamp")


def manifest_path(base: str) -> str:
    return f"{base.rstrip('/')}__manifest"


def ingest(
    df: DataFrame,
    base: str,
    at: datetime,
    source: str = "listings",
    save_metadata: bool = True,
    clean_before_run: bool = False,
    per_page: int = PER_PAGE,
) -> DataFrame:
    """Land a batch and record it; returns its manifest row, whose file_path holds this batch only.

    A batch without rows is not landed. One that was landed before, at the same
    time with the same rows, is left as it is: its folder is complete. One that
    cannot be read or written is recorded as failed, with no records and its day
    as path, and the error is logged. `clean_before_run` replaces what was landed
    before, and its manifest, once the batch is written.
    """
    spark = df.sparkSession
    day = f"year={at:%Y}/month={at:%m}/day={at:%d}"
    path = f"{versions.current(spark, base)}/{day}"
    records = size = 0
    failed = False
    try:
        counted = batch_fingerprint(df).first()
        if counted["total_records"]:
            path, records = _land(df, base, f"{day}/batch-{at:%H%M%S%f}-{counted['fingerprint']}", clean_before_run), counted["total_records"]
            size = files.size_of(spark, path)
    except (PySparkException, Py4JJavaError) as problem:
        log.error("batch of %s not landed: %s", at.isoformat(), problem)
        failed = True
    count = spark.range(1).select(F.lit(records).cast("long").alias("total_records"))
    row = _manifest_of(count, at, path, source, per_page, size, failed)
    landed = records > 0
    if save_metadata and (landed or failed):
        append_manifest(row, manifest_path(base), clean_before_run and landed)
    return row


def _land(df: DataFrame, base: str, batch: str, clean_before_run: bool) -> str:
    """Write a batch to its folder, if it is not there whole; returns the folder."""
    spark = df.sparkSession

    def to(where: str) -> None:
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{where}/{batch}")

    if clean_before_run:
        return f"{versions.replace(spark, base, to, keep=1)}/{batch}"
    where = versions.current(spark, base)
    if not files.exists(spark, f"{where}/{batch}/_SUCCESS"):
        to(where)
    return f"{where}/{batch}"
