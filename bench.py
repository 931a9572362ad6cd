"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR is the folder of the given tables, BENCH_CPUS the number of local
threads. `silver_*` and `gold_*` are the whole stages, writes included.
Everything is run once untimed first, the stages on the smaller input, so that
the times are those of a session that has been running.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from checks import standin
from checks.queries import QUERIES
from sitewright.operators import locate, rules
from sitewright.plans.curate import transform_listings
from sitewright.plans.report import build_gold
from sitewright.session import SETTINGS
from sitewright.sources.files import fresh_path, staged
from sitewright.sources.tables import read_silver

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Single queries, timed from the given tables to their last row.
QUERY_NAMES = [
    "clean_sites", "coordinates_valid", "silver_quality_metrics", "dedup_by_id", "batch_fingerprint",
    "gold_by_type", "gold_by_country", "gold_by_state", "gold_by_type_and_country",
    "gold_by_type_and_state", "gold_summary", "density_grid", "top_cities", "state_coverage",
    "profile_table", "validate_bronze", "validate_silver", "volume_anomaly", "run_history_flat",
    "page_slice", "lookup_capped", "lookup_coordinates", "header_metrics", "country_share", "validate_gold",
    "validation_summary", "gold_build_report",
]


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stages(spark, label, raw, timed) -> None:
    path = fresh_path(spark, label)

    def silver():
        return transform_listings(spark, raw, path, standin.RUN_AT).quality.first()["total_records"]

    rows = timed(f"silver_{label}", silver)
    table = read_silver(spark, path)
    timed(f"gold_{label}", lambda: build_gold(table, fresh_path(spark, "gold"), standin.RUN_AT).collect())
    timed(f"rules_{label}", lambda: rules.suite_summary(rules.validate_silver(table, rows)).collect())
    points = [staged(t, "gazetteer") for t in standin.gazetteers(table)]

    def look_up():
        found = staged(locate.lookup_coordinates(table, *points), "found")
        drain(locate.coordinates_valid(locate.apply_lookup(table.drop("coordinates_valid"), found)))

    timed(f"lookup_{label}", look_up)


def main() -> None:
    spark = session()
    times: dict[str, float] = {}

    def timed(name, work):
        started = time.monotonic()
        result = work()
        times[name] = round(time.monotonic() - started, 3)
        return result

    small, large = standin.sites(spark, SF_DIR), standin.large_sites(spark, SF_DIR)
    stages(spark, "customers", small, lambda name, work: work())
    for label, raw in (("customers", small), ("lines", large)):
        stages(spark, label, raw, timed)
    for name in QUERY_NAMES:
        drain(QUERIES[name](spark, SF_DIR))
        timed(name, lambda: drain(QUERIES[name](spark, SF_DIR)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
