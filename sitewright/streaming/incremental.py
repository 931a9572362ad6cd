"""Landed batches as a stream: each run takes only what it has not seen, and nothing counts twice.

The stream tells which landed folders have new files. Such a folder is read
whole, as it is now, and its curated rows replace those it had (see keyed). So a
batch whose files were written again, and a micro-batch that is repeated after a
failure, leave the same rows as if each had come once.

With the curated rows of a take go its partial states: place totals, and pairs
of id and place. The reporting tables are rolled up from the states of all
ingestions, so that a new batch costs its own rows and the states, and never a
pass over the curated table.
"""

from datetime import datetime
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sitewright.operators.gold import DIMENSIONS, FLAGS, Parts, gold_tables, id_places, place_totals
from sitewright.operators.select import equal_to
from sitewright.plans.curate import curated
from sitewright.schema import LANDING_PARTITIONS, LISTING_COLUMNS, SILVER_PARTITIONS, SILVER_SCHEMA
from sitewright.sources import keyed, versions

AS_TEXT = ", ".join(f"`{name}` STRING" for name in LISTING_COLUMNS)
PLACES = StructType(
    [*(StructField(c, StringType()) for c in DIMENSIONS), *(StructField(c, LongType()) for c in ["rows", *FLAGS])]
)
PAIRS = StructType([StructField(c, StringType()) for c in ["id", *DIMENSIONS[:3]]])


def _folder():
    """The folder a row's file is in, as Spark writes it."""
    return F.regexp_replace("_metadata.file_path", "/[^/]*$", "")


def stream_folders(spark: SparkSession, base: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The folders of newly landed records, one row per record."""
    where = versions.current(spark, base)
    parts = ", ".join(f"{name} INT" for name in LANDING_PARTITIONS)
    reader = spark.readStream.schema(f"{AS_TEXT}, {parts}").option("basePath", where)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(f"{where}/year=*").select(_folder().alias("folder"))


def take_folders(spark: SparkSession, folders: list[str], silver_path: str, run_at: datetime) -> None:
    """Curate landed folders as they are now; their rows and partial states replace those they had."""
    raw = spark.read.schema(AS_TEXT).json([unquote(folder) for folder in folders])
    rows = curated(raw.withColumn(keyed.KEY, F.md5(_folder())), run_at, keep=[keyed.KEY])
    keys = spark.createDataFrame([(folder,) for folder in folders], "folder string").select(F.md5("folder").alias(keyed.KEY))
    written = keyed.put(rows, silver_path, SILVER_PARTITIONS, keys)
    keyed.put(place_totals(written, [keyed.KEY, *DIMENSIONS]), f"{silver_path}__places", keys=keys)
    keyed.put(id_places(written, [keyed.KEY, *DIMENSIONS[:3]]), f"{silver_path}__pairs", keys=keys)


def incremental_silver(
    spark: SparkSession,
    base: str,
    silver_path: str,
    checkpoint: str,
    run_at: datetime,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Curate every batch landed, or landed again, since the last run, then stop.

    The names of a micro-batch's folders come to the driver, of which there are
    no more than files per trigger.
    """

    def each(batch: DataFrame, _: int) -> None:
        folders = sorted(row[0] for row in batch.distinct().collect())
        if folders:
            take_folders(batch.sparkSession, folders, silver_path, run_at)

    return (
        stream_folders(spark, base, max_files_per_trigger)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_incremental(spark: SparkSession, silver_path: str, filters: dict[str, Any] | None = None) -> DataFrame:
    """The curated rows of all ingestions; filters on the partition columns read only those folders."""
    return equal_to(keyed.read(spark, silver_path, SILVER_SCHEMA).drop(keyed.KEY), filters)


def incremental_gold(spark: SparkSession, silver_path: str, run_at: datetime) -> dict[str, DataFrame]:
    """All reporting tables from the states of all ingestions; only the table of listings reads the curated rows."""
    places = keyed.read(spark, f"{silver_path}__places", PLACES).drop(keyed.KEY)
    ids = keyed.read(spark, f"{silver_path}__pairs", PAIRS).drop(keyed.KEY)
    return gold_tables(read_incremental(spark, silver_path), Parts(places, ids), run_at)
