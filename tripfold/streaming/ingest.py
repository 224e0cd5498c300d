"""Preparation of raw CSV files as they arrive.

The batch step reads a whole year again for one new file. This form runs the same column
logic on new files only and appends to the same kind of table; file source, checkpoint and
Parquet sink together write each row once, restarts included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripfold.sources.prepare import STATUS, tagged_trips


def read_arriving_csv(
    spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def prepare_available(
    raw: DataFrame,
    layout: str,
    year: int,
    path: str,
    checkpoint: str,
    partition_by: str = "pickup_day",
) -> StreamingQuery:
    """Prepare everything that has arrived since the last run, then stop.

    Rows land as the batch job writes them: tagged, rejects in partitions of their own, so that
    ``read_trips`` and ``accounting_of`` work on either table.
    """
    return (
        tagged_trips(raw, layout, year)
        .hint("rebalance", STATUS, partition_by)
        .writeStream.format("parquet")
        .partitionBy(STATUS, partition_by)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
