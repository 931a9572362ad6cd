"""Report queries: top lists, shares, centroids, headline numbers."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewright.functions.numbers import percent, ratio, rows_where
from sitewright.operators.parts import distinct_counts, merge_parts
from sitewright.operators.select import exclude_country

COUNT = "brewery_count"


def top(df: DataFrame, n: int, *keys: str, by: str = COUNT) -> DataFrame:
    """The n highest rows; the keys decide between equals."""
    return df.orderBy(F.desc(by), *keys).limit(n)


def top_countries(by_country: DataFrame, n: int = 20) -> DataFrame:
    return top(by_country, n, "country_normalized")


def top_countries_excluding(by_country: DataFrame, country: str, n: int = 19) -> DataFrame:
    return top(exclude_country(by_country, country), n, "country_normalized")


def top_states(by_state: DataFrame, n: int = 20) -> DataFrame:
    return top(by_state, n, "country_normalized", "state")


def city_counts(df: DataFrame) -> DataFrame:
    """Rows per city, state and country, for rows that have all three."""
    keys = ["city", "state", "country_normalized"]
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def top_cities(df: DataFrame, n: int = 10) -> DataFrame:
    return top(city_counts(df), n, "city", "state", "country_normalized", by="count")


def country_centroids(df: DataFrame) -> DataFrame:
    """Named rows and mean point of each country."""
    return (
        df.where(F.col("country_normalized").isNotNull())
        .groupBy("country_normalized")
        .agg(
            F.count("name").alias("total"),
            F.avg("latitude").alias("mean_latitude"),
            F.avg("longitude").alias("mean_longitude"),
        )
        .orderBy(F.desc("total"), "country_normalized")
    )


def selection_metrics(df: DataFrame) -> DataFrame:
    """Rows, countries and types of a selection."""
    combos = df.groupBy("country_normalized", "brewery_type_normalized").agg(
        F.count(F.lit(1)).alias("n")
    )
    return merge_parts(
        [],
        combos.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")),
        distinct_counts(
            combos, [], {"countries": "country_normalized", "types": "brewery_type_normalized"}
        ),
    )


def selector_domains(df: DataFrame) -> DataFrame:
    """The values each selector offers: (selector, value), sorted."""
    combos = df.select("country_normalized", "brewery_type_normalized").distinct()
    pairs = F.array(
        F.struct(F.lit("country").alias("selector"), F.col("country_normalized").alias("value")),
        F.struct(F.lit("type").alias("selector"), F.col("brewery_type_normalized").alias("value")),
    )
    return (
        combos.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("selector", "value")
    )


def header_metrics(summary: DataFrame, by_country: DataFrame, by_type: DataFrame) -> DataFrame:
    """Headline numbers; without a summary, countries and types are the rows of their tables."""
    size = F.count(F.lit(1))
    parts = merge_parts(
        [],
        summary.agg(
            F.max("total_breweries").alias("total"),
            F.max("distinct_countries").alias("countries"),
            F.max("distinct_types").alias("types"),
            F.max("with_coordinates").alias("placed"),
        ),
        by_country.agg(size.alias("country_rows")),
        by_type.agg(size.alias("type_rows")),
    )
    total = F.coalesce("total", F.lit(0))
    return parts.select(
        total.alias("total_breweries"),
        F.coalesce("countries", "country_rows").alias("total_countries"),
        F.coalesce("types", "type_rows").alias("total_types"),
        F.coalesce(percent("placed", "total", None), F.lit(0.0)).alias("coordinate_coverage"),
    )


def quality_scorecard(summary: DataFrame) -> DataFrame:
    """Coverage percentages and their mean, with the counts behind them."""
    return summary.select(
        percent("with_coordinates", "total_breweries", None).alias("coordinate_percent"),
        percent("with_contact", "total_breweries", None).alias("contact_percent"),
        "with_coordinates",
        "with_contact",
        (F.col("total_breweries") - F.col("with_coordinates")).alias("without_coordinates"),
        "complete_records",
        percent("complete_records", "total_breweries", None).alias("complete_percent"),
    ).withColumn("overall_quality", (F.col("coordinate_percent") + F.col("contact_percent")) / 2)


def country_share(by_country: DataFrame, summary: DataFrame, country: str) -> DataFrame:
    """One country's rows and its percentage of all; 0 if it does not occur."""
    own = F.sum(F.when(F.col("country_normalized") == country, F.col(COUNT)))
    total = summary.select(F.max("total_breweries")).scalar()
    return (
        by_country.agg(F.coalesce(own, F.lit(0)).alias(COUNT))
        .withColumn("share_percent", F.coalesce(percent(F.col(COUNT), total, None), F.lit(0.0)))
        .select(F.lit(country).alias("country"), COUNT, "share_percent")
    )


def type_share(by_type: DataFrame) -> DataFrame:
    """Each type's percentage of all rows; the most common type is marked."""
    overall = by_type.agg(F.sum(COUNT).alias("total"), F.max(COUNT).alias("highest"))
    top_type = top(by_type, 1, "brewery_type_normalized").select(
        F.coalesce("brewery_type_normalized", F.lit("")).alias("name")
    )
    total = overall.select("total").scalar()
    return by_type.select(
        "brewery_type_normalized",
        COUNT,
        percent(F.col(COUNT), total, None).alias("share_percent"),
        (F.coalesce("brewery_type_normalized", F.lit("")) == top_type.scalar()).alias("most_common"),
    )


def country_state_rollup(by_state: DataFrame, n: int = 20) -> DataFrame:
    """Totals of the top states, of their countries, and of all: (level, country, state, count).

    Level 0 is a state, 1 a country, 2 everything.
    """
    return (
        top_states(by_state, n)
        .rollup("country_normalized", "state")
        .agg(
            (F.grouping("country_normalized") + F.grouping("state")).cast("int").alias("level"),
            F.sum(COUNT).alias(COUNT),
        )
    )


def state_coverage(df: DataFrame) -> DataFrame:
    """Rows per state, and the shares with a valid point and with complete data."""
    counts = (
        df.where(F.col("state").isNotNull())
        .groupBy("country_normalized", "state")
        .agg(
            F.count(F.lit(1)).alias(COUNT),
            rows_where(F.col("coordinates_valid")).alias("_valid"),
            rows_where(F.col("is_complete")).alias("_complete"),
        )
    )
    return counts.select(
        "country_normalized",
        "state",
        COUNT,
        ratio("_valid", COUNT).alias("valid_share"),
        ratio("_complete", COUNT).alias("complete_share"),
    )


def type_mix(table: DataFrame, *within: str) -> DataFrame:
    """Each type's share of its state's or country's rows, from the rolled-up table."""
    whole = F.sum(COUNT).over(Window.partitionBy(*within))
    return table.select(
        *within, "brewery_type_normalized", COUNT, ratio(F.col(COUNT), whole).alias("type_share")
    )


def type_mix_by_state(by_type_and_state: DataFrame) -> DataFrame:
    return type_mix(by_type_and_state, "country_normalized", "state")


def type_mix_by_country(by_type_and_country: DataFrame) -> DataFrame:
    return type_mix(by_type_and_country, "country_normalized")
