"""Curated and reporting tables as Parquet."""

import logging
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from sitewright.operators.select import equal_to
from sitewright.schema import (
    GOLD_SCHEMAS,
    REPORT_TABLES,
    SILVER_PARTITIONS,
    SILVER_SCHEMA,
    empty_table,
)
from sitewright.sources import files, versions

log = logging.getLogger(__name__)


def write_silver(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    observe: tuple[Observation, list[Column]] | None = None,
) -> str:
    """Write the curated listings, partitioned by country and state unless told otherwise.

    Rows are rebalanced on the partition columns: a small state becomes one
    file, and a state with much of the data is written by as many tasks as its
    size needs. The table is replaced when all is written (see versions);
    `mode="append"` adds to what is there. `observe` names aggregates to gather
    while the rows go by, behind the shuffle, where a row of a task that is run
    again counts once.
    """
    columns = partition_by or SILVER_PARTITIONS
    rows = df.hint("rebalance", *columns)
    if observe:
        rows = rows.observe(observe[0], *observe[1])
    _write(rows, path, mode, columns)
    return path


def _write(df: DataFrame, path: str, mode: str, partition_by: list[str] | None = None) -> None:
    spark = df.sparkSession

    def to(where: str) -> None:
        df.write.mode("append").partitionBy(*(partition_by or [])).parquet(where)

    if mode == "append":
        to(versions.current(spark, path))
    elif mode == "overwrite":
        versions.replace(spark, path, to)
    else:
        raise ValueError(f"mode '{mode}' is neither overwrite nor append")


def read_silver(
    spark: SparkSession,
    path: str,
    filters: dict[str, Any] | None = None,
    extra: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The curated listings; filters on the partition columns read only those folders.

    The declared schema is read, so no file is opened to find it out and a
    state such as '01' stays text. Columns that some runs added are named in
    `extra`, or found by opening every file with `merge_schema`.
    """
    if merge_schema:
        reader = spark.read.option("mergeSchema", "true")
    else:
        reader = spark.read.schema(StructType(SILVER_SCHEMA.fields + (extra.fields if extra else [])))
    return equal_to(reader.parquet(versions.current(spark, path)), filters)


def write_gold(df: DataFrame, base: str, table: str, mode: str = "overwrite") -> str:
    """Write a reporting table, which is replaced when all is written; returns its path."""
    path = f"{base}/{table}"
    _write(df, path, mode)
    return path


def read_gold(
    spark: SparkSession, base: str, table: str, filters: dict[str, Any] | None = None
) -> DataFrame:
    path = f"{base}/{table}"
    if not versions.exists(spark, path):
        raise ValueError(f"table '{table}' does not exist at {path}")
    return equal_to(spark.read.parquet(versions.current(spark, path)), filters)


def list_gold(spark: SparkSession, base: str) -> list[str]:
    """Names of the tables that were written whole."""
    return [name for name in files.folders(spark, base) if versions.exists(spark, f"{base}/{name}")]


def load_gold_or_empty(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables reports read, by short name; one that cannot be read is empty.

    One row of each is read, so that damaged files are found here.
    """
    tables = {}
    for short, table in REPORT_TABLES.items():
        try:
            tables[short] = read_gold(spark, base, table)
            tables[short].limit(1).collect()
        except (ValueError, PySparkException, Py4JJavaError) as problem:
            log.warning("table %s not loaded: %s", table, problem)
            tables[short] = empty_table(spark, GOLD_SCHEMAS[table])
    return tables


def export_csv(df: DataFrame, path: str) -> str:
    """The rows as CSV files with a header each; a quote inside a value is doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
