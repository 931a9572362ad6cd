"""Every operator as a query over the given tables."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standin
from checks.standin import RUN_AT, cleaned, runs, silver, sites
from sitewright.operators import clean, explore, gold, locate, metrics, rules, select
from sitewright.operators import runs as run_ops
from sitewright.plans.daily import expected_totals
from sitewright.plans.curate import row_count
from sitewright.plans.report import GoldSet, build_gold, read_all_gold
from sitewright.schema import GOLD_SCHEMAS
from sitewright.sources import landing, tables
from sitewright.sources.files import fresh_path, staged
from sitewright.streaming.incremental import incremental_gold, incremental_silver, read_incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_NOW = datetime(2001, 8, 1, 12, 0)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def over(source: Callable[[SparkSession, str], DataFrame], **operators: Callable[[DataFrame], DataFrame]):
    """Register queries that apply one operator to one source."""
    for name, operator in operators.items():
        QUERIES[name] = lambda spark, sf_dir, operator=operator: operator(source(spark, sf_dir))


def gold_of(name: str):
    return lambda spark, sf_dir: gold.gold_table(name, silver(spark, sf_dir), RUN_AT)


def map_rows(spark, sf_dir):
    return select.map_rows(silver(spark, sf_dir))


# Low enough that some keys of the given tables need several slots, and some do not;
# the given tables are small, and would be broadcast if nothing were said.
SLOTS = {"slot_rows": 8, "few_bytes": 0}


def lookup(spark, sf_dir, max_records=None, **planned):
    # Tables, as in a run: the lookup reads each more than once.
    rows = staged(cleaned(spark, sf_dir), "cleaned")
    points = [staged(table, "gazetteer") for table in standin.gazetteers(rows)]
    return rows, locate.lookup_coordinates(rows, *points, max_records=max_records, **planned)


# ---- sources and sinks ------------------------------------------------------


def landed(spark, sf_dir):
    rows, base = sites(spark, sf_dir), fresh_path(spark, "landed")
    landing.land_batch(rows, base, standin.landing_day(rows))
    return base


@query
def land_bronze(spark, sf_dir):
    rows = landing.read_landed_listings(spark, landed(spark, sf_dir))
    return rows.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("records"), F.count("latitude").alias("with_latitude")
    )


over(sites, batch_fingerprint=landing.batch_fingerprint)


@query
def ingestion_manifest(spark, sf_dir):
    row = landing.manifest_row(
        sites(spark, sf_dir), RUN_AT, "bronze/year=2026/month=01/day=21", "listings"
    )
    return row.select("*", "partition_date.*").drop("partition_date")


def _flat_manifest(df: DataFrame) -> DataFrame:
    return df.select("*", "partition_date.*").drop("partition_date")


over(
    standin.manifest,
    latest_ingestion=lambda m: _flat_manifest(landing.latest_ingestion(m)),
    list_ingestions=lambda m: _flat_manifest(landing.list_ingestions(m)),
)


@query
def read_bronze(spark, sf_dir):
    return landing.read_landed(spark, landed(spark, sf_dir))


@query
def read_ingestion(spark, sf_dir):
    """Two batches of one day, each read by its own path in the manifest."""
    rows, base = sites(spark, sf_dir), fresh_path(spark, "landed")
    has_point = F.col("latitude").isNotNull()
    paths = [landing.ingest(rows.where(part), base, RUN_AT).first()["file_path"] for part in (has_point, ~has_point)]
    read = [landing.read_batch(spark, path).withColumn("ingestion", F.lit(i)) for i, path in enumerate(paths, 1)]
    return read[0].unionByName(read[1])


@query
def read_bronze_by_date(spark, sf_dir):
    return landing.read_landed_listings(spark, landed(spark, sf_dir), {"month": 1, "day": 7})


def streamed(spark, sf_dir):
    base, out = landed(spark, sf_dir), fresh_path(spark, "silver")
    stream = incremental_silver(spark, base, out, fresh_path(spark, "progress"), RUN_AT)
    stream.awaitTermination()
    return read_incremental(spark, out)


QUERIES["incremental_silver"] = streamed


def three_batches(spark, sf_dir):
    """Three batches taken one after the other; the second is landed twice, the second time in new files."""
    rows = sites(spark, sf_dir)
    base, out, progress = (fresh_path(spark, name) for name in ("landed", "silver", "progress"))
    for third in (0, 1, 1, 2):
        batch = rows.where(F.col("id").cast("long") % 3 == third)
        path = landing.ingest(batch, base, RUN_AT).first()["file_path"]
        if third == 1:
            batch.write.mode("overwrite").json(path)
        incremental_silver(spark, base, out, progress, RUN_AT).awaitTermination()
    return out


@query
def incremental_retry(spark, sf_dir):
    return read_incremental(spark, three_batches(spark, sf_dir))


@query
def incremental_gold_by_state(spark, sf_dir):
    return incremental_gold(spark, three_batches(spark, sf_dir), RUN_AT)["breweries_by_state"]


@query
def incremental_gold_summary(spark, sf_dir):
    return incremental_gold(spark, three_batches(spark, sf_dir), RUN_AT)["brewery_summary_statistics"]


@query
def silver_roundtrip(spark, sf_dir):
    path = tables.write_silver(silver(spark, sf_dir), fresh_path(spark, "silver"))
    return tables.read_silver(spark, path)


@query
def read_silver_filtered(spark, sf_dir):
    path = tables.write_silver(silver(spark, sf_dir), fresh_path(spark, "silver"))
    return tables.read_silver(
        spark, path, {"country_normalized": "United States", "state": "NATION_8"}
    )


def built(spark, sf_dir):
    base = fresh_path(spark, "gold")
    return base, build_gold(silver(spark, sf_dir), base, RUN_AT)


@query
def gold_roundtrip(spark, sf_dir):
    return read_all_gold(spark, built(spark, sf_dir)[0])["breweries_by_type_and_state"]


@query
def read_gold_filtered(spark, sf_dir):
    base, _ = built(spark, sf_dir)
    return tables.read_gold(
        spark, base, "breweries_by_type_and_country", {"brewery_type_normalized": "brew_pub"}
    )


@query
def list_gold(spark, sf_dir):
    names = tables.list_gold(spark, built(spark, sf_dir)[0])
    return spark.createDataFrame([(name,) for name in names], "table_name string")


@query
def load_gold_or_empty(spark, sf_dir):
    """Rows of each loaded table; the summary is not written here, so it comes back empty."""
    base, rows = fresh_path(spark, "gold"), silver(spark, sf_dir)
    for name in GOLD_SCHEMAS:
        if name != "brewery_summary_statistics":
            tables.write_gold(gold.gold_table(name, rows, RUN_AT), base, name)
    sizes = None
    for short, table in tables.load_gold_or_empty(spark, base).items():
        one = table.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(short))
        sizes = one if sizes is None else sizes.unionByName(one)
    return sizes


@query
def export_filtered_csv(spark, sf_dir):
    rows = select.selected_rows(map_rows(spark, sf_dir), country="Brazil").select(*gold.REPORT_COLUMNS)
    path = tables.export_csv(rows, fresh_path(spark, "export"))
    return spark.read.option("header", True).option("escape", "\"").schema(GOLD_SCHEMAS["breweries"]).csv(path)


# ---- run history ------------------------------------------------------------


def run_records(spark, sf_dir):
    return run_ops.run_report(standin.run_rows(spark, sf_dir))


def _brief(records: DataFrame) -> DataFrame:
    return records.select(
        "execution_timestamp", "dag_run_id", "status", "data_quality.records_ingested"
    )


over(
    run_records,
    run_history_retained=lambda r: _brief(run_ops.retained_runs(r)),
    latest_run=lambda r: _brief(run_ops.latest_run(r)),
    last_n_runs=lambda r: _brief(run_ops.last_n_runs(r, 20)),
    run_history_window=lambda r: _brief(run_ops.run_history_window(r, RUN_NOW, 30)),
    run_report=lambda r: r.select(
        "execution_date",
        "status",
        *[F.col(f"validations.{layer}").alias(f"{layer}_ok") for layer in run_ops.LAYERS],
        "data_quality.*",
        "execution_times.*",
        *[f"rule_results.{layer}_success" for layer in run_ops.LAYERS],
        *[f"rule_results.{layer}_success_rate" for layer in run_ops.LAYERS],
    ),
    run_validation_table=run_ops.run_validation_table,
    run_history_flat=run_ops.run_history_flat,
    latest_run_card=run_ops.latest_run_card,
    stage_gates=run_ops.stage_gates,
)


@query
def enrichment_card(spark, sf_dir):
    rows, found = lookup(spark, sf_dir)
    filled = locate.coordinates_valid(locate.apply_lookup(rows, found, keep_level=True))
    rates = metrics.enrichment_rates(filled)
    return run_ops.enrichment_card(run_ops.run_report(standin.run_rows(spark, sf_dir), rates))


# ---- cleaning ---------------------------------------------------------------

over(
    sites,
    clean_sites=clean.clean_sites,
    normalize_country=lambda d: clean.normalize_country(clean.tidy_text(d)).select(
        "id", "name", "country_normalized"
    ),
    normalize_type=lambda d: clean.normalize_type(clean.tidy_text(d)).select(
        "id", "name", "brewery_type_normalized"
    ),
    full_address=lambda d: clean.add_full_address(clean.tidy_text(d)).select(
        "id", "name", "full_address"
    ),
    location_key=lambda d: clean.add_location_key(clean.tidy_text(d)).select(
        "id", "name", "location_key"
    ),
    quality_flags=lambda d: clean.quality_flags(clean.tidy_text(d)).select(
        "id", "name", "has_coordinates", "has_contact", "is_complete"
    ),
    add_processing_metadata=lambda d: clean.add_processing_metadata(d, RUN_AT).select(
        "id", "name", "silver_processed_at", "processing_date", "processing_year", "processing_month"
    ),
    enforce_schema=lambda d: clean.enforce_schema(
        # As a source that quotes its coordinates and leaves some columns out.
        d.drop("address_2", "address_3").withColumns(
            {
                "latitude": F.when(F.col("latitude") == 999, "n/a").otherwise(
                    F.col("latitude").cast("string")
                ),
                "longitude": F.col("longitude").cast("string"),
            }
        )
    ),
)

_POINT = ["id", "name", "country_normalized", "latitude", "longitude"]

over(
    cleaned,
    coordinate_checks=lambda d: locate.coordinate_checks(d).select(*_POINT, *locate.CHECKS),
    coordinates_valid=lambda d: locate.coordinates_valid(d).select(*_POINT, "coordinates_valid"),
    coordinate_breakdown=locate.coordinate_breakdown,
    dedup_by_id=lambda d: clean.dedup_by_id(d, ~F.col("is_complete"), F.col("name")),
    missing_coordinates=select.missing_coordinates,
    filter_by_type=lambda d: select.filter_by_type(d, "Brew Pub"),
    search_sites=lambda d: select.search_sites(d, "nation_1", 50),
    lookup_by_id=lambda d: select.lookup_by_id(d, "95"),
    page_slice=lambda d: select.page_slice(d.select("id", "name"), 3, 50),
    lookup_capped=lambda d: locate.lookup_capped(d, 100).select("id", "name"),
    distinct_ids=metrics.distinct_ids,
)

over(
    silver,
    gold_entity_table=gold.gold_entity_table,
    map_rows_valid=lambda d: select.map_rows(d).select(*_POINT),
    map_rows_suspicious=lambda d: select.suspicious_rows(d).select(*_POINT),
    map_rows_selected=lambda d: select.selected_rows(select.map_rows(d), "Canada", "brew_pub").select(*_POINT),
    silver_quality_metrics=metrics.silver_quality_metrics,
    silver_counts_by_dim=metrics.silver_counts_by_dim,
    profile_table=metrics.profile_table,
    silver_statistics=metrics.silver_statistics,
    state_coverage=explore.state_coverage,
)

# ---- lookup -----------------------------------------------------------------


@query
def lookup_coordinates(spark, sf_dir):
    return lookup(spark, sf_dir, **SLOTS)[1]


@query
def apply_lookup(spark, sf_dir):
    rows, found = lookup(spark, sf_dir, **SLOTS)
    filled = locate.apply_lookup(rows, staged(found, "found"), keep_level=True, **SLOTS)
    return filled.select(
        "id", "name", "latitude", "longitude", "has_coordinates", "is_complete", "geocoded_source"
    )


@query
def apply_lookup_capped(spark, sf_dir):
    rows, found = lookup(spark, sf_dir, max_records=100)
    filled = locate.apply_lookup(rows, found, recompute_complete=True)
    return filled.select("id", "name", "latitude", "longitude", "has_coordinates", "is_complete")


@query
def lookup_coverage(spark, sf_dir):
    rows, found = lookup(spark, sf_dir)
    return locate.lookup_coverage(rows, locate.apply_lookup(rows, found), found)


@query
def enrichment_rates(spark, sf_dir):
    rows, found = lookup(spark, sf_dir)
    return metrics.enrichment_rates(
        locate.coordinates_valid(locate.apply_lookup(rows, found, keep_level=True))
    )


@query
def layer_reconciliation(spark, sf_dir):
    """The raw listings against those left after repeated ids were dropped."""
    return run_ops.layer_reconciliation(
        sites(spark, sf_dir), clean.dedup_by_id(cleaned(spark, sf_dir), F.col("name"))
    )


@query
def union_batches(spark, sf_dir):
    rows = sites(spark, sf_dir)
    return landing.union_batches(
        rows.where(F.col("latitude").isNull()).drop("latitude", "longitude"),
        rows.where(F.col("latitude").isNotNull()),
    )


# ---- reporting tables -------------------------------------------------------

for _key, _table in {
    "gold_by_type": "breweries_by_type",
    "gold_by_country": "breweries_by_country",
    "gold_by_state": "breweries_by_state",
    "gold_by_type_and_country": "breweries_by_type_and_country",
    "gold_by_type_and_state": "breweries_by_type_and_state",
    "gold_summary": "brewery_summary_statistics",
}.items():
    QUERIES[_key] = gold_of(_table)


@query
def gold_build_report(spark, sf_dir):
    return built(spark, sf_dir)[1].drop("output_path")


# ---- report queries ---------------------------------------------------------

over(
    map_rows,
    density_grid=locate.density_grid,
    top_density_cells=locate.top_density_cells,
    top_cities=explore.top_cities,
    country_centroids=explore.country_centroids,
    selection_metrics=explore.selection_metrics,
    selector_domains=explore.selector_domains,
)
over(
    gold_of("breweries_by_country"),
    top_countries=lambda d: explore.top_countries(d).select("country_normalized", "brewery_count"),
    top_countries_excluding=lambda d: explore.top_countries_excluding(d, "United States").select(
        "country_normalized", "brewery_count"
    ),
)
over(
    gold_of("breweries_by_state"),
    top_states=lambda d: explore.top_states(d).drop("aggregation_timestamp"),
    country_state_rollup=explore.country_state_rollup,
)
over(gold_of("breweries_by_type"), type_share=explore.type_share)
over(gold_of("breweries_by_type_and_state"), type_mix_by_state=explore.type_mix_by_state)
over(gold_of("breweries_by_type_and_country"), type_mix_by_country=explore.type_mix_by_country)
over(gold_of("brewery_summary_statistics"), quality_scorecard=explore.quality_scorecard)


#: One set of reporting tables for each session and input.
_SETS: dict[tuple[str, str], GoldSet] = {}


def gold_set(spark, sf_dir) -> GoldSet:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SETS:
        _SETS[key] = GoldSet(spark, lambda: silver(spark, sf_dir), RUN_AT)
    return _SETS[key]


@query
def header_metrics(spark, sf_dir):
    names = ("brewery_summary_statistics", "breweries_by_country", "breweries_by_type")
    return explore.header_metrics(*[gold_set(spark, sf_dir).table(name) for name in names])


@query
def country_share(spark, sf_dir):
    names = ("breweries_by_country", "brewery_summary_statistics")
    return explore.country_share(*[gold_set(spark, sf_dir).table(name) for name in names], "United States")


# ---- rules ------------------------------------------------------------------


def suite(*rule_list: rules.Rule):
    return lambda df: rules.run_suite(df, "check", list(rule_list))


over(
    sites,
    rule_unique=suite(rules.Unique("id")),
    rule_not_null=suite(
        rules.NotNull("id"), rules.NotNull("name", 0.99), rules.NotNull("brewery_type", 0.95),
        rules.NotNull("ingestion_timestamp"),
    ),
    rule_row_count=suite(rules.RowCount(low=5_000, high=50_000)),
    rule_in_set=suite(
        rules.InSet("brewery_type", 0.95, ("Brew Pub", "BUILDING", "MACHINERY")),
        rules.InSet("brewery_type", 0.1, ("Brew Pub",)),
    ),
    rule_between=suite(
        rules.Between("latitude", 0.5, -90.0, 90.0), rules.Between("longitude", 1.0, -180.0, 180.0)
    ),
    rule_columns=suite(*rules.bronze_documented_rules()),
    validate_bronze=rules.validate_bronze,
)
over(
    silver,
    rule_pair_coverage=suite(rules.PairPresent("latitude", 0.85, "longitude")),
    rule_column_count=suite(rules.ColumnCount(low=20, high=30)),
    rule_valid_share=suite(rules.InSet("coordinates_valid", 0.85, (True,))),
    rule_no_null_island=suite(rules.NoNullIsland("latitude")),
)
over(
    gold_of("breweries_by_type"),
    rule_group_counts=suite(rules.Between("brewery_count", 1.0, 1, 50_000)),
    rule_top_entity=suite(
        rules.TopEntity("brewery_type_normalized", "brew_pub", k=1),
        rules.TopEntity("brewery_type_normalized", "micro", k=3),
    ),
)
over(
    gold_of("breweries_by_country"),
    rule_contains=suite(
        rules.Contains("country_normalized", "United States"), rules.Contains("country_normalized", "Peru")
    ),
)


@query
def rule_sum_matches(spark, sf_dir):
    """The state table adds up to the rows with a state; it does not add up to all rows."""
    rows = silver(spark, sf_dir)
    by_state = gold.gold_table("breweries_by_state", rows, RUN_AT)
    return rules.run_suite(
        by_state,
        "check",
        [
            rules.SumMatches("brewery_count", rows.agg(F.count("state"))),
            rules.SumMatches("brewery_count", rows.agg(F.count(F.lit(1)))),
        ],
    )


@query
def validate_silver(spark, sf_dir):
    rows = silver(spark, sf_dir)
    return rules.suite_summary(rules.validate_silver(rows))


def all_gold_rules(spark, sf_dir):
    """The rules of all tables, the listings' copy included, against the number of curated rows."""
    shared = gold_set(spark, sf_dir)
    tables, rows = shared.tables(), shared.silver()
    return rules.validate_gold(tables, row_count(rows), expected_totals(rows))


@query
def validate_gold(spark, sf_dir):
    return rules.suite_summary(all_gold_rules(spark, sf_dir))


@query
def validation_summary(spark, sf_dir):
    return rules.validation_summary(
        {
            "bronze": rules.validate_bronze(sites(spark, sf_dir)),
            "silver": rules.validate_silver(silver(spark, sf_dir)),
            "gold": all_gold_rules(spark, sf_dir),
        }
    )


over(runs, volume_anomaly=lambda r: rules.volume_anomaly(r, "run_date", "records"))
