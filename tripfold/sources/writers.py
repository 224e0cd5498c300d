"""Sinks: partitioned Parquet, plain Parquet, report sections."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    frame: DataFrame, path: str, *by: str, sort_within: tuple[str, ...] = ()
) -> None:
    """Overwrite a hive-partitioned Parquet table.

    Rebalancing gathers each partition value into few tasks, which avoids one small file per
    task and value, while adaptive execution splits a value too large for one task. Sorting
    inside the files gives narrow row-group statistics on the columns queries filter by.
    """
    write_rebalanced(frame.hint("rebalance", *by), path, *by, sort_within=sort_within)


def write_rebalanced(frame: DataFrame, path: str, *by: str, sort_within: tuple[str, ...] = ()) -> None:
    """As ``write_partitioned``, for rows that were rebalanced before their other columns were made."""
    arranged = frame.sortWithinPartitions(*by, *sort_within)
    arranged.write.mode("overwrite").partitionBy(*by).parquet(path)


def replace_partitions(
    frame: DataFrame, path: str, *by: str, sort_within: tuple[str, ...] = (), within: Column | None = None
) -> None:
    """Put the frame's rows in place of all rows the table has in their partitions.

    Spark stages the new files and swaps in whole partition directories when the job commits
    (dynamic partition overwrite): other partitions keep their files, a job that fails changes
    nothing, and the same call again gives the same table. The frame has to hold everything
    that belongs in the partitions it touches.

    ``within`` is a condition on the partition columns that says what the frame is the whole of, a
    day or a month. Rows outside it raise an error before anything is replaced, and partitions
    inside it that the frame no longer has rows for are emptied.
    """
    spark, had = frame.sparkSession, []
    if within is not None:
        had = _partitions(spark, path, by, within)
        message = F.concat(F.lit("row outside the replaced partitions: "), F.to_json(F.struct(*by)))
        checked = F.when(within, F.col(by[0])).otherwise(F.raise_error(message))
        frame = frame.withColumn(by[0], checked)
    # The partitions the job writes, from its own pass over the rows.
    seen = Observation("replaced")
    values = F.struct(*(F.col(name).cast("string").alias(name) for name in by))
    observed = frame.observe(seen, F.collect_set(values).alias("partitions"))
    arranged = observed.hint("rebalance", *by).sortWithinPartitions(*by, *sort_within)
    arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    if had:
        now = {tuple(row) for row in seen.get["partitions"]}
        for gone in had:
            if gone not in now:
                # Static overwrite of one directory, by a file without rows.
                frame.drop(*by).limit(0).write.mode("overwrite").parquet(f"{path}/{_directory(by, gone)}")


def _partitions(spark: SparkSession, path: str, by: tuple[str, ...], within: Column) -> list[tuple]:
    """Values, as text, of the partitions a table has inside a condition."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    found = table.filter(within).select(*(F.col(name).cast("string") for name in by)).distinct()
    return [tuple(row) for row in found.collect()]


def _directory(by: tuple[str, ...], values: tuple) -> str:
    return "/".join(
        f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else quote(value, safe='')}"
        for name, value in zip(by, values)
    )


def write_table(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(path)


def write_sections(sections: Mapping[str, DataFrame], path: str) -> None:
    """Write each result table of a report as JSON lines under its own directory.

    Executors write the rows; nothing is gathered on the driver.
    """
    for name, frame in sections.items():
        frame.write.mode("overwrite").json(f"{path}/{name}")
