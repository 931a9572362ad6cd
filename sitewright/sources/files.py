"""Paths on whatever storage Spark uses."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted, without hidden ones; none if there is no folder."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    entries = fs.listStatus(hadoop_path)
    names = [e.getPath().getName() for e in entries if e.isDirectory()]
    return sorted(name for name in names if not name.startswith((".", "_")))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes under a path, 0 if there is none."""
    fs, hadoop_path = _fs(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of all that is in a folder, sorted; none if there is no folder."""
    fs, hadoop_path = _fs(spark, path)
    return sorted(e.getPath().getName() for e in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, which must not be there yet, and its folder."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.createNewFile(hadoop_path):
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint folder, or else a folder of its warehouse, which is shared too."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/sitewright-staged"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/sitewright-{label}-{uuid.uuid4().hex}"


def measured(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The rows by way of a written table in the shared folder, and its size in bytes."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), size_of(df.sparkSession, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows by way of a written table in the shared folder.

    For a result that several later jobs read: its inputs are not read again,
    later jobs read only the columns they need, and a lost executor costs no
    recomputation.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
