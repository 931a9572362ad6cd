"""Run history: one appended record per run, and one table of what was appended before.

Records are appended as files of their own. `compact_runs` moves them into one
Parquet table that keeps the last runs; readers see both, and a run that is in
both, since a compaction was killed between its two steps, once.
"""

from pyspark.sql import DataFrame, SparkSession

from sitewright.operators.parts import first_by
from sitewright.operators.runs import RUN_TIME, retained_runs
from sitewright.schema import RETAINED_RUNS, RUN_SCHEMA, empty_table
from sitewright.sources import files, versions


def table_path(path: str) -> str:
    return f"{path.rstrip('/')}__table"


def append_run(record: DataFrame, path: str) -> None:
    """Add a run."""
    record.write.mode("append").json(path)


def _appended(spark: SparkSession, path: str) -> list[str]:
    return [f"{path.rstrip('/')}/{name}" for name in files.names(spark, path) if not name.startswith(("_", "."))]


def _all_runs(spark: SparkSession, path: str, appended: list[str]) -> DataFrame:
    runs = spark.read.schema(RUN_SCHEMA).json(appended) if appended else empty_table(spark, RUN_SCHEMA)
    table = table_path(path)
    if versions.exists(spark, table):
        runs = runs.unionByName(spark.read.schema(RUN_SCHEMA).parquet(versions.current(spark, table)))
    return first_by(runs, [RUN_TIME, "dag_run_id"])


def read_runs(spark: SparkSession, path: str, keep: int | None = None) -> DataFrame:
    """All runs, or the last `keep` of them, oldest first, with every field they were recorded with."""
    runs = _all_runs(spark, path, _appended(spark, path))
    return runs.orderBy(RUN_TIME) if keep is None else retained_runs(runs, keep)


def compact_runs(spark: SparkSession, path: str, keep: int = RETAINED_RUNS) -> DataFrame:
    """Keep the last runs in the table and remove the files they were appended in; returns the table."""
    appended = _appended(spark, path)
    kept = retained_runs(_all_runs(spark, path, appended), keep)
    where = versions.replace(spark, table_path(path), lambda to: kept.coalesce(1).write.parquet(to))
    for name in appended:
        files.delete(spark, name)
    return spark.read.schema(RUN_SCHEMA).parquet(where)
