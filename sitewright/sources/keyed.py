"""Tables made of pieces that replace themselves: each key's rows are those of its last write.

A write, called a take, goes to a folder of its own, partitioned by key. When it
is complete one line per key is added to a ledger: this key, that take. Readers
join the folders with each key's last line, which leaves out all other folders.
So a key that is written again, because its input changed or because a run was
repeated, replaces its rows and is not counted twice; a write that is killed is
not in the ledger and not seen.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitewright.operators.parts import BROADCAST_BYTES
from sitewright.sources import files

KEY, TAKE = "ingestion", "take"
LEDGER = "take long, folder string, ingestion string, records long"


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}__ledger"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All takes of all keys."""
    where = ledger_path(path)
    if not files.exists(spark, where):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).json(where)


def last_takes(ledger: DataFrame) -> DataFrame:
    """Each key's last take and its folder."""
    return ledger.groupBy(KEY).agg(F.max(F.struct("take", "folder", "records")).alias("last")).select(KEY, "last.*")


def put(df: DataFrame, path: str, partition_by: list[str] | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Write the rows of some keys (column `ingestion`), which replace those they had; returns the written rows.

    `keys` names the keys that are replaced, also those that have no rows now;
    without it they are those of the rows.
    """
    spark = df.sparkSession
    base, folder = path.rstrip("/"), uuid.uuid4().hex
    columns = [KEY, *(partition_by or [])]
    where = f"{base}/{TAKE}={folder}"
    df.hint("rebalance", *columns).write.partitionBy(*columns).parquet(where)
    written = spark.read.schema(df.schema).parquet(where)
    number = (read_ledger(spark, path).agg(F.max("take")).first()[0] or 0) + 1
    lines = written.groupBy(KEY).agg(F.count(F.lit(1)).alias("records"))
    if keys is not None:
        lines = keys.select(KEY).distinct().join(lines, KEY, "left").select(KEY, F.coalesce("records", F.lit(0)).alias("records"))
    lines = lines.select(F.lit(number).cast("long").alias("take"), F.lit(folder).alias("folder"), KEY, "records")
    # One file, so that the take counts for all of its keys or for none.
    lines.coalesce(1).write.mode("append").json(ledger_path(path))
    return written


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all keys, each from its last take, with the key in `ingestion`."""
    base = path.rstrip("/")
    if not files.exists(spark, base):
        return spark.createDataFrame([], schema).withColumn(KEY, F.lit(None).cast("string"))
    fields = StructType([f for f in schema.fields if f.name != KEY]).add(KEY, "string").add(TAKE, "string")
    rows = spark.read.schema(fields).option("basePath", base).parquet(base)
    last = last_takes(read_ledger(spark, path)).select(KEY, F.col("folder").alias(TAKE))
    small = files.size_of(spark, ledger_path(path)) <= BROADCAST_BYTES
    return rows.join(F.broadcast(last) if small else last, [KEY, TAKE], "left_semi").drop(TAKE)


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Remove the folders no ledger line leads to any more; returns their number. No reader or writer may be at work."""
    base = path.rstrip("/")
    last = {(row["folder"], row[KEY]) for row in last_takes(read_ledger(spark, path)).toLocalIterator()}
    dropped = 0
    for take in files.folders(spark, base):
        keys = files.folders(spark, f"{base}/{take}")
        for key in keys:
            if (take.partition("=")[2], key.partition("=")[2]) not in last:
                files.delete(spark, f"{base}/{take}/{key}")
                dropped += 1
    return dropped
