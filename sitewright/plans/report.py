"""The curated table to the reporting tables."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.operators.gold import gold_tables, shared_parts
from sitewright.schema import GOLD_SCHEMAS
from sitewright.sources import files, versions
from sitewright.sources.tables import read_gold, write_gold


def build_gold(silver: DataFrame, base: str, run_at: datetime) -> DataFrame:
    """Write all reporting tables; returns name, path and row count of each.

    The shared parts are made first. The writes are then submitted together:
    most of them are small, and one alone would leave the cluster idle. The row
    counts are read from the written files, which hold them.
    """
    spark = silver.sparkSession
    tables = gold_tables(silver, shared_parts(silver), run_at)
    with ThreadPoolExecutor(len(tables)) as pool:
        writes = {name: pool.submit(write_gold, table, base, name) for name, table in tables.items()}
        paths = {name: write.result() for name, write in writes.items()}
    report = None
    for name, path in paths.items():
        written = spark.read.schema(tables[name].schema).parquet(versions.current(spark, path))
        one = written.agg(F.count(F.lit(1)).alias("record_count"))
        one = one.select(
            F.lit(name).alias("table_name"), F.lit(path).alias("output_path"), "record_count"
        )
        report = one if report is None else report.unionByName(one)
    return report


def read_all_gold(spark, base: str) -> dict[str, DataFrame]:
    return {name: read_gold(spark, base, name) for name in GOLD_SCHEMAS}


class GoldSet:
    """All reporting tables of one curated input, built when first asked for, and shared by whoever asks after.

    `curated` gives the listings; it is called and read once. The tables lie in
    the session's shared folder until the set's owner drops them, at the latest
    at the end of a `with` block.
    """

    def __init__(self, spark: SparkSession, curated: Callable[[], DataFrame], run_at: datetime):
        self.spark, self.curated, self.run_at = spark, curated, run_at
        self.base: str | None = None
        self.lock = Lock()

    def __enter__(self) -> "GoldSet":
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def _built(self) -> str:
        with self.lock:
            if self.base is None or not files.exists(self.spark, self.base):
                base = files.fresh_path(self.spark, "gold-set")
                write_gold(self.curated(), base, "_silver")
                self.base = base
                build_gold(self.silver(), base, self.run_at)
        return self.base

    def silver(self) -> DataFrame:
        """The listings the tables are made from."""
        return read_gold(self.spark, self.base or self._built(), "_silver")

    def table(self, name: str) -> DataFrame:
        return read_gold(self.spark, self._built(), name)

    def tables(self) -> dict[str, DataFrame]:
        return read_all_gold(self.spark, self._built())

    def drop(self) -> None:
        """Remove the tables; they are built again if somebody asks."""
        with self.lock:
            if self.base is not None:
                files.delete(self.spark, self.base)
                self.base = None
