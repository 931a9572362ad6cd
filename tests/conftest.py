from datetime import datetime

import pytest
from pyspark.sql import SparkSession

from sitewright.schema import LISTING_SCHEMA

RUN_AT = datetime(2026, 1, 21, 6, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def listings(spark):
    """Makes raw listings from dicts of the columns that matter."""

    def make(*rows):
        full = [tuple(row.get(name) for name in LISTING_SCHEMA.names) for row in rows]
        return spark.createDataFrame(full, LISTING_SCHEMA)

    return make


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def by(df, *keys):
    """The rows by their key or keys; each key must be there once."""
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]
        assert key not in found, key
        found[key] = row
    return found
