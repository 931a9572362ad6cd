"""The given tables seen as listings, gazetteers and runs.

Listings are derived from customers by whole-number arithmetic, so that any SQL
engine gives the same rows. They contain repeated ids, padding, blanks, country
spellings, nulls, points at (0, 0) and points off the globe.
"""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions import points
from sitewright.functions.text import joined
from sitewright.operators.clean import add_processing_metadata, clean_sites
from sitewright.operators.locate import address_key, coordinates_valid

RUN_AT = datetime(2026, 1, 21, 6, 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nth(key: Column, *cases: tuple[int, int, Column | None], otherwise: Column) -> Column:
    """The value of the first (divisor, remainder, value) that the key matches."""
    result = otherwise
    for divisor, remainder, value in reversed(cases):
        value = F.lit(None) if value is None else value
        result = F.when(key % divisor == remainder, value).otherwise(result)
    return result


def listings_from(keys: DataFrame) -> DataFrame:
    """Raw listings of rows (k, label, segment, balance, n_nationkey, n_name)."""
    k, text = F.col("k"), F.col("k").cast("string")
    address = _nth(k, (9, 0, F.lit("")), otherwise=F.concat(text, F.lit(" Main St")))
    spelling = F.element_at(
        F.array(*[F.lit(c) for c in (
            "USA", "US", "United States", "England", "Brazil", "Scotland", "Portugal", " Canada ",
        )]),
        F.col("n_nationkey") % 8 + 1,
    )
    zero, off = F.lit(0.0), F.lit(999.0)
    nothing = F.lit(None).cast("string")
    return keys.select(
        (k - F.when(k % 97 == 96, 1).otherwise(0)).cast("string").alias("id"),
        _nth(k, (10, 0, F.concat(F.lit("  "), "label", F.lit("  "))), otherwise=F.col("label")).alias("name"),
        _nth(k, (41, 0, None), (6, 0, F.lit("Brew Pub")), otherwise=F.col("segment")).alias("brewery_type"),
        address.alias("address_1"),
        nothing.alias("address_2"),
        nothing.alias("address_3"),
        _nth(k, (23, 0, None), otherwise=F.concat(F.lit("City_"), (k % 37).cast("string"))).alias("city"),
        nothing.alias("state_province"),
        _nth(k, (13, 0, F.lit("   ")), otherwise=F.col("n_name")).alias("state"),
        (k % 500 + 10000).cast("string").alias("postal_code"),
        spelling.alias("country"),
        _nth(
            k, (4, 3, None), (50, 1, zero),
            otherwise=((k * 11) % 361 - 180).cast("double") + 0.5,
        ).alias("longitude"),
        _nth(
            k, (4, 3, None), (50, 1, zero), (61, 0, off),
            otherwise=((k * 7) % 181 - 90).cast("double") + 0.25,
        ).alias("latitude"),
        F.when(F.col("balance") >= 0, F.concat(F.lit("+"), text)).alias("phone"),
        _nth(
            k, (3, 0, None),
            otherwise=F.concat(F.lit("http://"), F.lower("segment"), F.lit(".example")),
        ).alias("website_url"),
        address.alias("street"),
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw listing per customer."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return listings_from(
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("k"),
            F.col("c_name").alias("label"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
            "n_nationkey",
            "n_name",
        )
    )


def large_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw listing per order line, for timing."""
    line, nation = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "nation")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return listings_from(
        line.join(nation, k % 25 == F.col("n_nationkey")).select(
            k.alias("k"),
            F.concat(F.lit("Line#"), k.cast("string")).alias("label"),
            F.concat(F.lit("Mode "), "l_returnflag", F.lit("/"), "l_linestatus").alias("segment"),
            (F.col("l_quantity") - 5).alias("balance"),
            "n_nationkey",
            "n_name",
        )
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_processing_metadata(clean_sites(sites(spark, sf_dir)), RUN_AT)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coordinates_valid(cleaned(spark, sf_dir))


def gazetteers(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Address and city points, both unique by key, derived from the cleaned listings.

    Addresses are known where there is a phone; a city lies at the lowest point
    of the listings in it.
    """
    number = F.regexp_extract("name", r"(\d+)$", 1).cast("long")
    by_address = (
        listings.where(points.missing() & F.col("phone").isNotNull())
        .groupBy(address_key().alias("key"))
        .agg(
            F.min((number * 5 % 120 - 60).cast("double") + 0.5).alias("latitude"),
            F.min((number * 3 % 240 - 120).cast("double") + 0.5).alias("longitude"),
        )
        .where(F.col("key").isNotNull())
    )
    by_city = (
        listings.where(points.present() & F.col("city").isNotNull() & F.col("country_normalized").isNotNull())
        .groupBy(joined("city", "country_normalized").alias("key"))
        .agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    )
    return by_address, by_city


def landing_day(listings: DataFrame) -> Column:
    """The day a listing is landed on: one of 28, by its id."""
    return F.date_add(F.lit(date(2026, 1, 1)), (F.col("id").cast("long") % 28).cast("int"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per order date, with its number of records."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("run_date"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs as ingestion manifest rows."""
    day = F.col("run_date").cast("string")
    at = F.concat(day, F.lit("T06:30:00"))
    path = F.concat(F.lit("bronze/day="), day)
    return runs(spark, sf_dir).select(
        F.md5(F.concat(at, path)).alias("ingestion_id"),
        at.alias("ingestion_timestamp"),
        F.lit("orders").alias("source"),
        F.col("records").alias("total_records"),
        path.alias("file_path"),
        (F.col("records") * 640).alias("file_size_bytes"),
        F.struct(
            F.year("run_date").alias("year"),
            F.month("run_date").alias("month"),
            F.day("run_date").alias("day"),
        ).alias("partition_date"),
        F.lit("success").alias("status"),
        F.ceil(F.col("records") / 200).alias("pages_processed"),
    )


def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs as flat rows of a run report; some runs failed, some lost records."""
    day, n, records = F.col("run_date"), F.dayofyear("run_date"), F.col("records")
    text = day.cast("string")
    silver_failed, gold_failed = n % 11 == 0, n % 13 == 0
    kept = F.when(silver_failed, 0).otherwise(records - F.when(n % 5 == 0, 1).otherwise(0))
    return runs(spark, sf_dir).select(
        F.concat(text, F.lit("T06:30:00")).alias("execution_timestamp"),
        text.alias("execution_date"),
        F.concat(F.lit("scheduled__"), text, F.lit("T06:30:00+00:00")).alias("dag_run_id"),
        F.lit("success").alias("bronze_status"),
        records.alias("bronze_records"),
        F.concat(F.lit("bronze/day="), text).alias("bronze_path"),
        F.ceil(records / 2).alias("pages_processed"),
        F.when(silver_failed, "failed").otherwise("success").alias("silver_status"),
        kept.alias("silver_records"),
        F.lit(8).alias("silver_countries"),
        F.lit(6).alias("silver_types"),
        F.lit("silver").alias("silver_path"),
        F.when(~silver_failed, records * 0.25).alias("silver_time"),
        F.when(gold_failed, "failed").otherwise("success").alias("gold_status"),
        F.when(gold_failed, 0).otherwise(7).alias("gold_tables"),
        F.when(~gold_failed, records * 0.5).alias("gold_time"),
        F.lit(8).alias("bronze_rules"),
        (8 - n % 3).alias("bronze_passed"),
        (n % 3).alias("bronze_failed"),
        F.when(~silver_failed, 5).alias("silver_rules"),
        F.when(~silver_failed, 5 - n % 2).alias("silver_passed"),
        F.when(~silver_failed, n % 2).alias("silver_failed"),
        F.when(gold_failed, 0).otherwise(7).alias("gold_rules"),
        F.when(gold_failed, 0).otherwise(7).alias("gold_passed"),
        F.lit(0).alias("gold_failed"),
    )
