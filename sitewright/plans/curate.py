"""Raw listings to the curated table."""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sitewright.operators.clean import add_processing_metadata, clean_sites, dedup_by_id, enforce_schema
from sitewright.operators.locate import (
    apply_lookup,
    coordinates_valid,
    lookup_coordinates,
    lookup_coverage_of,
)
from sitewright.operators.metrics import enrichment_counts, quality_counts, rates_of, with_quality_rates
from sitewright.operators.parts import merge_parts
from sitewright.operators.rules import LIMITS, SILVER_SUITE, Limits, judge_measured, row_measures, silver_rules
from sitewright.sources.files import staged
from sitewright.sources.tables import read_silver, write_silver

def curated(raw: DataFrame, run_at: datetime, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned, stamped and checked listings, without a lookup; `keep` names columns to carry along."""
    return coordinates_valid(add_processing_metadata(clean_sites(enforce_schema(raw, keep)), run_at))


def located(
    cleaned: DataFrame,
    gazetteers: tuple[DataFrame, DataFrame],
    max_records: int | None = None,
    keep_level: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Cleaned listings with looked-up points, checked, and the lookup's own result."""
    found = lookup_coordinates(cleaned, *gazetteers, max_records=max_records)
    filled = apply_lookup(cleaned, found, keep_level=keep_level)
    return coordinates_valid(filled), found


@dataclass(frozen=True)
class Curated:
    """What is known of a curated table once it is written, each as one row, or as rows per rule.

    `quality` are its quality metrics with its distinct countries and types,
    `rates` those of enrichment, `rules` the results of its suite, `coverage`
    that of the lookup, if there was one.
    """

    quality: DataFrame
    rates: DataFrame
    rules: DataFrame
    coverage: DataFrame | None


def transform_listings(
    spark: SparkSession,
    raw: DataFrame,
    silver_path: str,
    run_at: datetime,
    gazetteers: tuple[DataFrame, DataFrame] | None = None,
    max_records: int | None = None,
    partition_by: list[str] | None = None,
    keep_level: bool = False,
    unique_ids: bool = False,
    bronze_count: int | None = None,
    limits: Limits = LIMITS,
) -> Curated:
    """Write the curated table; returns what was gathered while it was written.

    Without a lookup the raw data is read once. With one, the cleaned rows are
    written aside first, since lookup, join and coverage each read some of
    their columns; so they are with `unique_ids`, which leaves one row per id,
    a complete one before others. All counts are observed in the write itself.
    Only distinct ids, countries and types take a pass over the written table.
    """
    found = None
    cleaned = add_processing_metadata(clean_sites(enforce_schema(raw)), run_at)
    if unique_ids:
        cleaned = dedup_by_id(staged(cleaned, "cleaned"), ~F.col("is_complete"))
    if gazetteers is None:
        ready = coordinates_valid(cleaned)
    else:
        cleaned = staged(cleaned, "cleaned")
        found = staged(lookup_coordinates(cleaned, *gazetteers, max_records=max_records), "found")
        ready = coordinates_valid(apply_lookup(cleaned, found, keep_level=keep_level))
    suite = silver_rules(bronze_count, limits)
    seen = Observation("silver")
    gathered = [*quality_counts(), *enrichment_counts(ready.columns), *row_measures(ready, SILVER_SUITE, suite)]
    write_silver(ready, silver_path, partition_by, observe=(seen, gathered))
    counts = spark.range(1).select(*[F.lit(value).cast("long").alias(name) for name, value in seen.get.items()])
    distinct = _distinct(read_silver(spark, silver_path))
    quality = with_quality_rates(merge_parts([], counts.drop("_rows"), distinct))
    coverage = lookup_coverage_of(cleaned, counts, found) if found is not None else None
    return Curated(quality, rates_of(counts, "total_records"), judge_measured(ready, counts, SILVER_SUITE, suite), coverage)


def _distinct(silver: DataFrame) -> DataFrame:
    """How many ids, countries and types there are, null being one, in one pass over three columns."""
    names = {"unique_ids": "id", "countries": "country_normalized", "types": "brewery_type_normalized"}
    combos = silver.groupBy(*names.values()).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("counted"), F.col(c).alias("value")) for n, c in names.items()]))
    values = combos.select(pairs).distinct()
    return values.agg(*[F.count_if(F.col("counted") == name).alias(name) for name in names])


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
