"""Quality metrics, profiles and statistics."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions import points
from sitewright.functions.numbers import percent, ratio, rows_where
from sitewright.operators.parts import merge_parts
from sitewright.schema import SILVER_PARTITIONS


def distinct_ids(df: DataFrame) -> DataFrame:
    return df.select("id").distinct()


def _id_count(df: DataFrame) -> DataFrame:
    """How many distinct ids there are; null is one of them."""
    return distinct_ids(df).agg(F.count(F.lit(1)).alias("unique_ids"))


def quality_counts() -> list[Column]:
    """The counts of silver_quality_metrics that need rows only, as aggregates."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        rows_where(F.col("name").isNull()).alias("null_names"),
        rows_where(F.col("brewery_type").isNull()).alias("null_types"),
        rows_where(F.col("country").isNull()).alias("null_countries"),
        rows_where(F.col("state").isNull()).alias("null_states"),
        rows_where(F.col("has_coordinates")).alias("with_coordinates"),
        rows_where(F.col("has_contact")).alias("with_contact"),
        rows_where(F.col("is_complete")).alias("complete_records"),
    ]


def with_quality_rates(counts: DataFrame) -> DataFrame:
    """The counts and their rates, which are null when there are no rows."""
    return counts.withColumns(
        {
            "completeness_rate": percent("complete_records", "total_records"),
            "coordinate_coverage": percent("with_coordinates", "total_records"),
            "contact_coverage": percent("with_contact", "total_records"),
        }
    )


def silver_quality_metrics(df: DataFrame) -> DataFrame:
    """Counts and rates of one run. The rates are null when there are no rows."""
    return with_quality_rates(merge_parts([], _id_count(df), df.agg(*quality_counts())))


def counts_by(df: DataFrame, dimensions: dict[str, str]) -> DataFrame:
    """Rows per value of several columns in one pass: (dimension, value, count)."""
    combos = df.groupBy(*dimensions.values()).agg(F.count(F.lit(1)).alias("n"))
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("dimension"), F.col(column).alias("value"))
                for name, column in dimensions.items()
            ]
        )
    )
    return (
        combos.select(pairs.alias("p"), "n")
        .groupBy("p.dimension", "p.value")
        .agg(F.sum("n").alias("count"))
    )


def silver_counts_by_dim(df: DataFrame) -> DataFrame:
    return counts_by(
        df, {"by_type": "brewery_type_normalized", "by_country": "country_normalized"}
    )


def count_maps(df: DataFrame) -> DataFrame:
    """The counts by type and by country as one row of two maps; null is named 'null'.

    For reports. The maps hold one entry per type and per country, not per row.
    """
    long = silver_counts_by_dim(df).withColumn("value", F.coalesce("value", F.lit("null")))
    entry = F.struct("value", "count")

    def of(name: str):
        return F.map_from_entries(
            F.collect_list(F.when(F.col("dimension") == name, entry))
        ).alias(name)

    return long.agg(of("by_type"), of("by_country"))


def profile_table(df: DataFrame) -> DataFrame:
    """Nulls per column that has any, next to the table's size and its duplicate ids.

    A table without nulls gives one row with a null column name.
    """
    nulls = {name: f"_n{i}" for i, name in enumerate(df.columns)}
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            *[rows_where(F.col(f"`{name}`").isNull()).alias(n) for name, n in nulls.items()],
        )
    ]
    if "id" in df.columns:
        parts.append(_id_count(df))
    counts = merge_parts([], *parts)
    found = F.filter(
        F.array(
            *[
                F.struct(F.lit(name).alias("column_name"), F.col(n).alias("null_count"))
                for name, n in nulls.items()
            ]
        ),
        lambda c: c.getField("null_count") > 0,
    )
    duplicates = F.col("row_count") - F.col("unique_ids") if "id" in df.columns else F.lit(None)
    return counts.select(
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        duplicates.cast("long").alias("duplicate_count"),
        F.explode_outer(found).alias("c"),
    ).select("c.column_name", "c.null_count", "row_count", "column_count", "duplicate_count")


RATES = ("coordinate_coverage", "valid_coordinates_rate", "geocoded_rate", "country_normalized_rate")


def enrichment_counts(have: Sequence[str]) -> list[Column]:
    """How many rows have what enrichment_rates is about, as aggregates `{rate}_rows`, for a table with these columns."""
    counted = {
        "coordinate_coverage": points.present(),
        "valid_coordinates_rate": F.col("coordinates_valid") if "coordinates_valid" in have else F.lit(False),
        "geocoded_rate": F.col("geocoded_source").isNotNull() if "geocoded_source" in have else F.lit(False),
        "country_normalized_rate": F.col("country_normalized").isNotNull(),
    }
    return [rows_where(counted[name]).alias(f"{name}_rows") for name in RATES]


def rates_of(counts: DataFrame, total: str) -> DataFrame:
    return counts.select(*[F.coalesce(ratio(f"{name}_rows", total), F.lit(0.0)).alias(name) for name in RATES])


def enrichment_rates(df: DataFrame) -> DataFrame:
    """Shares of rows with a point, a valid point, a looked-up point and a country; 0 if no rows."""
    return rates_of(df.agg(F.count(F.lit(1)).alias("total"), *enrichment_counts(df.columns)), "total")


def silver_statistics(df: DataFrame, top: int = 10) -> DataFrame:
    """Size, columns, partition columns, top countries and states, and all types.

    Rows are (dimension, value, count); only the total and the groups have a count.
    """
    dims = {
        "by_country": "country_normalized",
        "by_state": "state",
        "by_type": "brewery_type_normalized",
    }
    counts = counts_by(df, dims)
    lists = []
    for name in dims:
        one = counts.where(F.col("dimension") == name)
        if name == "by_state":
            one = one.where(F.col("value").isNotNull())
        if name != "by_type":
            one = one.orderBy(F.desc("count"), F.asc_nulls_first("value")).limit(top)
        lists.append(one)
    facts = [("total_records", None), *[("columns", c) for c in df.columns]]
    facts += [("partitions", c) for c in SILVER_PARTITIONS if c in df.columns]
    listed = F.explode(
        F.array(*[F.struct(F.lit(d).alias("dimension"), F.lit(v).alias("value")) for d, v in facts])
    )
    size = df.agg(F.count(F.lit(1)).alias("count")).select(listed.alias("f"), "count")
    total = F.when(F.col("f.dimension") == "total_records", F.col("count"))
    result = size.select("f.dimension", "f.value", total.alias("count"))
    for one in lists:
        result = result.unionByName(one)
    return result
