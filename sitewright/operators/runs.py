"""Run history and run reports."""

from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions.numbers import percent
from sitewright.operators.parts import merge_parts
from sitewright.schema import RETAINED_RUNS

RUN_TIME = "execution_timestamp"
LOSS_LIMIT = 5.0
SECONDS_PER_PAGE = 0.5
LAYERS = ("bronze", "silver", "gold")
# What a run may tell of its curated table and its lookup.
QUALITY = (
    "unique_ids", "null_names", "null_types", "null_countries", "null_states", "with_coordinates", "with_contact",
    "complete_records", "completeness_rate", "coordinate_coverage", "contact_coverage",
)
LOOKUP = tuple(
    f"lookup_{x}"
    for x in ("before_with", "after_with", "new_coordinates", "attempted", "successful", "failed", "success_rate", "improvement_percent")
)


# ---- history ----------------------------------------------------------------


def newest(df: DataFrame, n: int | None, at: str) -> DataFrame:
    """The n newest rows, newest first; all of them when n is absent or 0."""
    ordered = df.orderBy(F.desc(at))
    return ordered.limit(n) if n else ordered


def retained_runs(runs: DataFrame, keep: int = RETAINED_RUNS) -> DataFrame:
    """The last `keep` runs, oldest first."""
    return newest(runs, keep, RUN_TIME).orderBy(RUN_TIME)


def latest_run(runs: DataFrame) -> DataFrame:
    return newest(runs, 1, RUN_TIME)


def last_n_runs(runs: DataFrame, n: int | None = None) -> DataFrame:
    return newest(runs, n, RUN_TIME).orderBy(RUN_TIME) if n else runs.orderBy(RUN_TIME)


def run_history_window(runs: DataFrame, now: datetime, days: int = 30) -> DataFrame:
    """Runs of the last `days` days before `now`, with their time as a timestamp."""
    cutoff = F.lit((now - timedelta(days=days)).isoformat()).cast("timestamp_ntz")
    dated = runs.withColumn(RUN_TIME, F.col(RUN_TIME).cast("timestamp_ntz"))
    return dated.where(F.col(RUN_TIME) >= cutoff)


# ---- reconciliation and report ----------------------------------------------


def loss_rate(before: str | Column, after: str | Column) -> Column:
    before, after = (F.col(c) if isinstance(c, str) else c for c in (before, after))
    return F.coalesce(percent(before - after, before, None), F.lit(0.0))


def layer_reconciliation(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Row counts of two layers, what was lost and kept in percent, and whether that is a warning."""
    counts = merge_parts(
        [],
        bronze.agg(F.count(F.lit(1)).alias("records_ingested")),
        silver.agg(F.count(F.lit(1)).alias("records_transformed")),
    )
    rates = counts.withColumns(
        {
            "data_loss_rate": loss_rate("records_ingested", "records_transformed"),
            "retention_rate": percent("records_transformed", "records_ingested", None),
        }
    )
    return rates.withColumn("loss_warning", F.col("data_loss_rate") > LOSS_LIMIT)


def _or(name: str, default: Any) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def run_report(layers: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Run records from one flat row per run.

    `layers` holds, per run: execution_timestamp, execution_date, dag_run_id;
    {layer}_status; bronze_records, bronze_path, pages_processed;
    silver_records, silver_countries, silver_types, silver_path, silver_time;
    gold_tables, gold_time; and for each layer {layer}_rules, {layer}_passed and
    {layer}_failed. The run succeeded when its three layers did; rules that
    failed are reported but do not fail it. `rates` is the one-row result of
    enrichment_rates; without it the rates are taken from rate_{name}. Rates,
    QUALITY, LOOKUP, failed_stage and error may be missing.
    """

    def maybe(name: str, kind: str) -> Column:
        return (F.col(name) if name in layers.columns else F.lit(None)).cast(kind)

    def status(layer: str) -> Column:
        return F.coalesce(F.col(f"{layer}_status") == "success", F.lit(False))

    def rules_ok(layer: str) -> Column:
        return F.coalesce(
            (F.col(f"{layer}_failed") == 0) & (F.col(f"{layer}_rules") > 0), F.lit(False)
        )

    def rules_rate(layer: str) -> Column:
        value = percent(F.col(f"{layer}_passed"), F.col(f"{layer}_rules"), None)
        return F.coalesce(value, F.lit(0.0))

    names = ("coordinate_coverage", "valid_coordinates_rate", "geocoded_rate", "country_normalized_rate")
    if rates is not None:
        enrichment = rates.select(F.struct(*names)).scalar()
    else:
        enrichment = F.struct(*[maybe(f"rate_{name}", "double").alias(name) for name in names])
    bronze_time = _or("pages_processed", 0) * F.lit(SECONDS_PER_PAGE)
    silver_time = _or("silver_time", 0.0).cast("double")
    gold_time = _or("gold_time", 0.0).cast("double")

    def result(layer: str, total: str, *more: Column) -> Column:
        return F.struct(
            rules_ok(layer).alias("success"),
            rules_rate(layer).alias("success_rate"),
            _or(f"{layer}_rules", 0).cast("long").alias(total),
            _or(f"{layer}_passed", 0).cast("long").alias("passed"),
            _or(f"{layer}_failed", 0).cast("long").alias("failed"),
            *more,
        )

    all_ok = status("bronze") & status("silver") & status("gold")
    return layers.select(
        "execution_timestamp",
        "execution_date",
        "dag_run_id",
        F.when(all_ok, "success").otherwise("failed").alias("status"),
        F.struct(*[status(layer).alias(layer) for layer in LAYERS]).alias("validations"),
        F.struct(
            _or("bronze_records", 0).cast("long").alias("records_ingested"),
            _or("silver_records", 0).cast("long").alias("records_transformed"),
            _or("gold_tables", 0).cast("long").alias("aggregations_created"),
            loss_rate(_or("bronze_records", 0), _or("silver_records", 0)).alias("data_loss_rate"),
        ).alias("data_quality"),
        F.struct(
            *[rules_ok(layer).alias(f"{layer}_success") for layer in LAYERS],
            *[rules_rate(layer).alias(f"{layer}_success_rate") for layer in LAYERS],
        ).alias("rule_results"),
        F.struct(
            F.col("bronze_records").cast("long").alias("records"),
            F.col("bronze_path").alias("path"),
            rules_ok("bronze").alias("quality_success"),
        ).alias("bronze_layer"),
        F.struct(
            F.col("silver_records").cast("long").alias("records"),
            F.col("silver_countries").cast("long").alias("countries"),
            F.col("silver_types").cast("long").alias("types"),
            F.col("silver_path").alias("path"),
            rules_ok("silver").alias("quality_success"),
            enrichment.alias("enrichment"),
            F.struct(*[maybe(name, "double").alias(name) for name in QUALITY]).alias("quality"),
            F.struct(*[maybe(name, "double").alias(name.removeprefix("lookup_")) for name in LOOKUP]).alias("lookup"),
        ).alias("silver_layer"),
        F.struct(
            F.col("gold_tables").cast("long").alias("aggregations"),
            gold_time.alias("processing_time"),
            rules_ok("gold").alias("quality_success"),
        ).alias("gold_layer"),
        F.struct(
            bronze_time.cast("double").alias("bronze_ingestion_time"),
            silver_time.alias("silver_transformation_time"),
            gold_time.alias("gold_aggregation_time"),
            (bronze_time + silver_time + gold_time).cast("double").alias("total_pipeline_time"),
        ).alias("execution_times"),
        F.struct(
            result("bronze", "total_expectations").alias("bronze"),
            result("silver", "total_expectations", enrichment.alias("enrichment_stats")).alias("silver"),
            result("gold", "total_aggregations").alias("gold"),
        ).alias("validation_results"),
        maybe("failed_stage", "string").alias("failed_stage"),
        maybe("error", "string").alias("error"),
    )


# ---- views of run records ---------------------------------------------------


def run_validation_table(runs: DataFrame) -> DataFrame:
    """Three rows per run, one per layer: success, rate and counts; missing values as 0 or false."""
    rows = []
    for layer in LAYERS:
        total = "total_aggregations" if layer == "gold" else "total_expectations"
        at = f"validation_results.{layer}"
        rows.append(
            F.struct(
                F.lit(layer).alias("layer"),
                _or(f"{at}.success", False).alias("success"),
                _or(f"{at}.success_rate", 0.0).alias("success_rate"),
                _or(f"{at}.passed", 0).cast("long").alias("passed"),
                _or(f"{at}.failed", 0).cast("long").alias("failed"),
                _or(f"{at}.{total}", 0).cast("long").alias("total"),
            )
        )
    return runs.select("execution_date", F.inline(F.array(*rows)))


def run_history_flat(runs: DataFrame) -> DataFrame:
    """One flat row per run, oldest first, with defaults for what a run did not record."""
    return runs.orderBy(RUN_TIME).select(
        _or("execution_date", "N/A").alias("execution_date"),
        _or("status", "unknown").alias("status"),
        _or("data_quality.records_ingested", 0).cast("long").alias("records"),
        _or("execution_times.total_pipeline_time", 0.0).alias("total_time"),
        _or("execution_times.bronze_ingestion_time", 0.0).alias("bronze_time"),
        _or("execution_times.silver_transformation_time", 0.0).alias("silver_time"),
        _or("execution_times.gold_aggregation_time", 0.0).alias("gold_time"),
    )


def latest_run_card(runs: DataFrame) -> DataFrame:
    """The newest run: date, status, short run id, stage times, volumes and loss."""
    short_id = F.substring(F.substring_index(_or("dag_run_id", "N/A"), "__", -1), 1, 15)
    return latest_run(runs).select(
        _or("execution_date", "N/A").alias("execution_date"),
        F.upper(_or("status", "unknown")).alias("status"),
        short_id.alias("run_id"),
        _or("execution_times.bronze_ingestion_time", 0.0).alias("bronze_time"),
        _or("execution_times.silver_transformation_time", 0.0).alias("silver_time"),
        _or("execution_times.gold_aggregation_time", 0.0).alias("gold_time"),
        _or("execution_times.total_pipeline_time", 0.0).alias("total_time"),
        _or("data_quality.records_ingested", 0).cast("long").alias("records_ingested"),
        _or("data_quality.records_transformed", 0).cast("long").alias("records_transformed"),
        _or("data_quality.aggregations_created", 0).cast("long").alias("aggregations"),
        _or("data_quality.data_loss_rate", 0.0).alias("data_loss_rate"),
    )


def enrichment_card(runs: DataFrame) -> DataFrame:
    """The four enrichment rates of the newest run, in percent."""
    at = "validation_results.silver.enrichment_stats"
    names = ("coordinate_coverage", "valid_coordinates_rate", "geocoded_rate", "country_normalized_rate")
    return latest_run(runs).select(
        *[(_or(f"{at}.{name}", 0.0) * 100).alias(name) for name in names]
    )


# ---- gates ------------------------------------------------------------------


def stage_gates(runs: DataFrame) -> DataFrame:
    """Which stages of each run may start, and whether its landed batch is to be checked.

    Silver needs a landed batch; gold needs curated rows; the report needs tables.
    """
    ok = F.lit("success")
    records, rows, tables = (
        _or(f"data_quality.{name}", 0)
        for name in ("records_ingested", "records_transformed", "aggregations_created")
    )
    landed = _or("validations.bronze", False)
    curated = _or("validations.silver", False) & (rows > 0)
    built = _or("validations.gold", False) & (tables > 0)
    reason = (
        F.when(~landed, "bronze layer did not succeed")
        .when(~_or("validations.silver", False), "silver layer did not succeed")
        .when(rows == 0, "no rows in silver layer")
        .when(~_or("validations.gold", False), "gold layer did not succeed")
        .when(tables == 0, "no tables in gold layer")
        .otherwise(ok)
    )
    return runs.select(
        RUN_TIME,
        landed.alias("may_curate"),
        curated.alias("may_aggregate"),
        built.alias("may_report"),
        (landed & (records > 0)).alias("check_bronze"),
        reason.alias("verdict"),
    )


def require_stages(runs: DataFrame) -> DataFrame:
    """The runs as given; reading them fails with the reason if a gate of any is shut."""
    verdict = stage_gates(runs).select(F.max(F.when(F.col("verdict") != "success", F.col("verdict"))))
    reason = verdict.scalar()
    return runs.where(F.assert_true(reason.isNull(), reason).isNull())
