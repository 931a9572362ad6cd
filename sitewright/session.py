"""A session with the settings the plans rely on."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Merge small shuffle partitions and split large ones at run time.
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A retried write task must not leave its first attempt's files behind.
    "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version": "1",
}


def get_session(app_name: str = "sitewright", master: str | None = None, **settings) -> SparkSession:
    """A session for jobs that bring none; the number of shuffle partitions is left to the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
