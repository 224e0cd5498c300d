"""Typed readers for raw CSV and prepared Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold import schemas
from tripfold.sources.prepare import KEPT, STATUS
from tripfold.sources.screen import BAD_FIELDS, LINE


def read_gps_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.TRIPS_GPS_RAW)


def read_zoned_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.TRIPS_ZONED_RAW)


def read_zones_csv(spark: SparkSession, path: str, types: str = "declared") -> DataFrame:
    """Zone lookup under canonical names.

    ``types`` is ``declared`` (explicit schema, a malformed id reads as null), ``text``
    (every column a string) or ``inferred`` (costs an extra pass over the file).
    """
    if types == "declared":
        zones = _read_csv(spark, path, schemas.ZONES_RAW)
    else:
        zones = spark.read.csv(path, header=True, inferSchema=types == "inferred")
    return zones.withColumnsRenamed(schemas.CANONICAL_NAMES)


def _read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every row of a prepared table, rejects included."""
    return spark.read.parquet(path)


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Prepared trips; partition columns come from the directories.

    A table that still holds rejects, as the prepare job writes it, gives its kept rows; the
    filter is on a partition column and prunes their directories.
    """
    rows = read_rows(spark, path)
    if STATUS in rows.columns:
        rows = rows.filter(F.col(STATUS) == KEPT).drop(STATUS, LINE, BAD_FIELDS)
    return rows


def read_zones(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Zone dimension from ``parquet`` or ``csv``, a file or a folder of them."""
    if kind == "csv":
        return read_zones_csv(spark, path)
    if kind != "parquet":
        raise ValueError(f"zones are parquet or csv, not {kind}")
    return spark.read.parquet(path).withColumnsRenamed(schemas.CANONICAL_NAMES)


def register_views(**frames: DataFrame) -> None:
    """Give SQL text access to frames under the given names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
