"""Session settings the operators were tuned with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # AQE picks the final shuffle width, splits skewed join and rebalance partitions, and
    # turns a planned sort-merge join into a broadcast one when the side proves small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A session that runs many queries outgrows the default of 100 compiled stages.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Spark 4.1 takes a union of two tables bucketed alike for bucketed, but reads it in twice as
    # many partitions: a group would be in the result twice.
    "spark.sql.unionOutputPartitioning": "false",
    # Recording the Python call site of every column costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create a session; ``master`` stays with spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
