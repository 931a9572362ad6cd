"""A whole run: land, check, curate, check, report, check, record."""

import logging
import time
from collections.abc import Callable
from datetime import datetime
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.operators import rules
from sitewright.operators.metrics import RATES
from sitewright.operators.runs import LAYERS, LOOKUP, LOSS_LIMIT, QUALITY, newest, run_report
from sitewright.plans.curate import row_count, transform_listings
from sitewright.plans.report import build_gold, read_all_gold
from sitewright.schema import LOOKUP_LEVEL
from sitewright.sources import history, landing
from sitewright.sources.files import staged
from sitewright.sources.journal import Journal, flat_run, read_journal
from sitewright.sources.tables import read_silver

log = logging.getLogger(__name__)

ROLLED_UP = [
    "breweries_by_type",
    "breweries_by_country",
    "breweries_by_state",
    "breweries_by_type_and_country",
    "breweries_by_type_and_state",
]


def _suite(spark: SparkSession, layer: str, build: Callable[[], DataFrame]) -> dict:
    """How a layer's rules went. A suite that cannot be built or run counts as failed and does not stop the run."""
    row = rules.summary_or_failure(spark, layer, build).first()
    return {
        f"{layer}_rules": row["total_expectations"],
        f"{layer}_passed": row["passed_expectations"],
        f"{layer}_failed": row["failed_expectations_count"],
    }


def _gold_suite(spark: SparkSession, build: Callable[[], DataFrame]) -> dict:
    """The same for the reporting tables, where tables are counted."""
    try:
        row = rules.combined_summary(rules.suite_summary(build())).first()
    except (PySparkException, Py4JJavaError, ValueError, TypeError) as problem:
        log.error("rules of the reporting tables could not run: %s", problem)
        return {"gold_rules": 0, "gold_passed": 0, "gold_failed": 0}
    return {
        "gold_rules": row["total_aggregations"], "gold_passed": row["passed_aggregations"], "gold_failed": row["failed_aggregations"],
    }


def volume_warning(spark: SparkSession, bronze_path: str) -> bool:
    """Whether the newest batch differs much in size from the one before it; it is logged if so."""
    manifest = landing.read_manifest(spark, landing.manifest_path(bronze_path))
    compared = rules.volume_anomaly(manifest, "ingestion_timestamp", "total_records")
    last = newest(compared, 1, "ingestion_timestamp").first()
    if last is None or not last["anomaly"]:
        return False
    log.warning(
        "volume changed by %.1f %%: %d rows before, %d now",
        last["variance"] * 100, last["previous_count"], last["current_count"],
    )
    return True


def expected_totals(silver: DataFrame) -> dict[str, DataFrame]:
    """What the counts of each rolled-up table must add up to, as one-row tables."""
    total = silver.agg(F.count(F.lit(1)))
    in_state = silver.agg(F.count("state"))
    return {name: in_state if name.endswith("state") else total for name in ROLLED_UP}


#: What stages find out for a run's record.
FOUND = {
    "bronze_status": "string", "bronze_records": "long", "bronze_path": "string", "pages_processed": "long",
    "silver_status": "string", "silver_records": "long", "silver_countries": "long", "silver_types": "long",
    "silver_path": "string", "silver_time": "double", "gold_status": "string", "gold_tables": "long", "gold_time": "double",
    **{f"{layer}_{x}": "long" for layer in LAYERS for x in ("rules", "passed", "failed")},
    **{name: "double" for name in QUALITY}, **{name: "double" for name in LOOKUP}, **{f"rate_{name}": "double" for name in RATES},
}


def run_day(
    spark: SparkSession,
    batch: DataFrame,
    base: str,
    run_at: datetime,
    run_id: str,
    gazetteers: tuple[DataFrame, DataFrame] | None = None,
    max_records: int | None = None,
    clean_before_run: bool = False,
    unique_ids: bool = False,
    limits: rules.Limits = rules.LIMITS,
) -> DataFrame:
    """Run every stage over one batch and append the run's record, which is returned.

    Each stage is noted in the journal before and after. One that raises is
    recorded as failed with its error, and those after it are skipped. A stage
    without anything to do, since the one before had no rows, is skipped too.
    The rules read the landed rows of this batch, as the curated table does.
    While that is written its counts, rates and rules are observed, so that it
    is read once for distinct values, and then by the reporting tables.
    """
    bronze_path, silver_path, gold_path = f"{base}/bronze", f"{base}/silver", f"{base}/gold"
    journal = Journal(spark, f"{base}/journal", run_at, run_id)
    known: dict[str, Any] = {}

    def land() -> dict:
        row = landing.ingest(batch, bronze_path, run_at, clean_before_run=clean_before_run).first()
        known.update(landed=row["status"] == "success", records=row["total_records"])
        if row["status"] == "failed":
            raise RuntimeError("the batch could not be read or written")
        if known["landed"]:
            known["rows"] = landing.read_batch(spark, row["file_path"])
        return {
            "bronze_status": row["status"], "bronze_records": row["total_records"], "bronze_path": row["file_path"],
            "pages_processed": row["pages_processed"],
        }

    def check_bronze() -> dict | None:
        if not known["landed"]:
            return None
        volume_warning(spark, bronze_path)
        return _suite(spark, "bronze", lambda: rules.validate_bronze(known["rows"], limits))

    def curate() -> dict | None:
        if not known["landed"]:
            return None
        started = time.monotonic()
        made = known["made"] = transform_listings(
            spark, known["rows"], silver_path, run_at, gazetteers, max_records, keep_level=gazetteers is not None,
            unique_ids=unique_ids, bronze_count=known["records"], limits=limits,
        )
        quality, rates = made.quality.first(), made.rates.first()
        coverage = made.coverage.first() if made.coverage is not None else None
        known["curated"] = quality["total_records"]
        return {
            "silver_status": "success", "silver_records": quality["total_records"], "silver_countries": quality["countries"],
            "silver_types": quality["types"], "silver_path": silver_path, "silver_time": round(time.monotonic() - started, 2),
            **{name: quality[name] for name in QUALITY}, **{f"rate_{name}": rates[name] for name in RATES},
            **({name: coverage[name.removeprefix("lookup_")] for name in LOOKUP} if coverage else {}),
        }

    def check_silver() -> dict | None:
        return _suite(spark, "silver", lambda: known["made"].rules) if "made" in known else None

    def report() -> dict | None:
        if not known.get("curated"):
            return None
        started = time.monotonic()
        known["silver"] = read_silver(spark, silver_path, extra=LOOKUP_LEVEL if gazetteers else None)
        tables = row_count(build_gold(known["silver"], gold_path, run_at))
        return {"gold_status": "success", "gold_tables": tables, "gold_time": round(time.monotonic() - started, 2)}

    def check_gold() -> dict | None:
        if "silver" not in known:
            return None
        return _gold_suite(
            spark,
            lambda: rules.validate_gold(read_all_gold(spark, gold_path), known["curated"], expected_totals(known["silver"]), limits),
        )

    for stage in (land, check_bronze, curate, check_silver, report, check_gold):
        journal.run(stage.__name__, stage)
    flat = flat_run(read_journal(spark, journal.path), FOUND, run_at, run_id)
    record = staged(run_report(flat), "run-record")
    history.append_run(record, f"{base}/runs")
    row = record.first()
    if row["failed_stage"]:
        log.error("run %s failed in stage %s: %s", run_id, row["failed_stage"], row["error"])
    if row["data_quality"]["data_loss_rate"] > LOSS_LIMIT:
        log.warning("%.2f %% of the landed rows are not in the curated table", row["data_quality"]["data_loss_rate"])
    return record
