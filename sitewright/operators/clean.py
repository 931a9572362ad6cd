"""Cleaning: raw listings to the curated shape."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewright.functions import points
from sitewright.functions.text import canonical_country, joined, place_key, slug, tidy
from sitewright.operators.parts import BROADCAST_BYTES
from sitewright.schema import LISTING_SCHEMA
from sitewright.sources.files import measured


def enforce_schema(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the declared columns and types, and those to keep; text that is no number becomes null."""
    have = set(df.columns)
    return df.select(
        *keep,
        *[
            (
                F.col(field.name).try_cast(field.dataType)
                if field.name in have
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in LISTING_SCHEMA
        ]
    )


def tidy_text(df: DataFrame) -> DataFrame:
    """Every text column trimmed, with blanks as null."""
    return df.select(
        *[
            tidy(field.name).alias(field.name) if isinstance(field.dataType, T.StringType) else field.name
            for field in df.schema
        ]
    )


def contact_flag() -> Column:
    return F.col("phone").isNotNull() | F.col("website_url").isNotNull()


def complete_flag() -> Column:
    return (
        points.present() & contact_flag() & F.col("city").isNotNull() & F.col("state").isNotNull()
    )


# What cleaning adds, each from tidied columns only.
_NAMES = {
    "country_normalized": lambda: canonical_country("country"),
    "brewery_type_normalized": lambda: slug("brewery_type"),
}
_ADDRESS = {
    "full_address": lambda: joined("address_1", "city", "state", "postal_code", "country"),
    "location_key": lambda: place_key("country", "state"),
}
_FLAGS = {
    "has_coordinates": points.present,
    "has_contact": contact_flag,
    "is_complete": complete_flag,
}


def _adding(df: DataFrame, *names: str) -> DataFrame:
    made = {**_NAMES, **_ADDRESS, **_FLAGS}
    return df.withColumns({name: made[name]() for name in names})


def normalize_country(df: DataFrame) -> DataFrame:
    return _adding(df, "country_normalized")


def normalize_type(df: DataFrame) -> DataFrame:
    return _adding(df, "brewery_type_normalized")


def add_full_address(df: DataFrame) -> DataFrame:
    return _adding(df, "full_address")


def add_location_key(df: DataFrame) -> DataFrame:
    return _adding(df, "location_key")


def quality_flags(df: DataFrame) -> DataFrame:
    return _adding(df, *_FLAGS)


def clean_sites(df: DataFrame) -> DataFrame:
    """Tidy text, canonical country and type, address fields and quality flags."""
    return _adding(tidy_text(df), *_NAMES, *_ADDRESS, *_FLAGS)


def add_processing_metadata(df: DataFrame, run_at: datetime) -> DataFrame:
    """The run's own time on every row, so a repeated run gives the same rows."""
    day = F.lit(run_at.date())
    return df.withColumns(
        {
            "silver_processed_at": F.lit(run_at.isoformat()),
            "processing_date": day,
            "processing_year": F.year(day),
            "processing_month": F.month(day),
        }
    )


def dedup_by_id(df: DataFrame, *prefer: Column) -> DataFrame:
    """One row per id: the one that `prefer` sorts first, then the lowest in column order.

    Rows without an id are not each other's duplicates: all of them stay. `df`
    should be a table, as it is read twice: hashes of ids are counted first, and
    only rows whose hash repeats are ranked. All others pass through, unsorted
    and, if the repeated hashes are few bytes, unshuffled. Ranking passes on the
    first row of an id from every task, so an id with many rows fills none.
    """
    known = df.where(F.col("id").isNotNull())
    hashed = F.xxhash64("id").alias("_h")
    counts = known.groupBy(hashed).agg(F.count(F.lit(1)).alias("_n"))
    repeated, size = measured(counts.where("_n > 1").select("_h"), "repeated-ids")
    side = F.broadcast(repeated) if size <= BROADCAST_BYTES else repeated
    rows = df.select("*", F.coalesce(hashed, F.lit(0)).alias("_h"), F.col("id").isNotNull().alias("_known"))
    again = rows.where("_known").join(side, "_h", "left_semi")
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c != "id"]
    order = Window.partitionBy("id").orderBy(*prefer, *rest)
    first = again.withColumn("_place", F.row_number().over(order)).where("_place = 1")
    # Two ids may share a hash; then both are ranked, each by itself.
    alone = rows.where("_known").join(side, "_h", "left_anti").unionByName(rows.where("NOT _known"))
    return first.select(*df.columns).unionByName(alone.select(*df.columns))
