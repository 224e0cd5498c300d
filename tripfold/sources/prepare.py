"""Raw trips to prepared trips: names, timestamps, validity, derived columns, accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold import schemas
from tripfold.functions.clock import minutes_between, parse_wall_clock
from tripfold.functions.geo import miles_to_km

STATUS = "ingest_status"
KEPT = "kept"
NULL_PICKUP = "null_pickup_ts"
BAD_YEAR = "bad_year"


# Partition columns beyond those every prepared table has.
CALENDAR = {"pickup_year": F.year, "pickup_month": F.month}
# What a table is split by whose days and months are replaced one at a time.
PERIOD = {**CALENDAR, "pickup_day": F.dayofmonth}
OUTSIDE_PERIOD = "outside_period"


def with_timestamps(raw: DataFrame, layout: str) -> DataFrame:
    """Canonical names plus both parsed timestamps; text of another layout gives null."""
    return raw.withColumnsRenamed(schemas.CANONICAL_NAMES).withColumns(
        {
            "pickup_ts": parse_wall_clock(F.col("tpep_pickup_datetime"), layout),
            "dropoff_ts": parse_wall_clock(F.col("tpep_dropoff_datetime"), layout),
        }
    )


def with_status(parsed: DataFrame, year: int) -> DataFrame:
    """Tag every row with what becomes of it, so one frame serves data and accounting."""
    pickup = F.col("pickup_ts")
    status = (
        F.when(pickup.isNull(), NULL_PICKUP)
        .when(F.year(pickup) != year, BAD_YEAR)
        .otherwise(KEPT)
    )
    return parsed.withColumn(STATUS, status)


def with_calendar(parsed: DataFrame) -> DataFrame:
    pickup = F.col("pickup_ts")
    return parsed.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "pickup_day": F.dayofmonth(pickup),
            "pickup_hour": F.hour(pickup),
        }
    )


def with_measures(parsed: DataFrame) -> DataFrame:
    return parsed.withColumns(
        {
            "duration_minutes": minutes_between(F.col("pickup_ts"), F.col("dropoff_ts")),
            "trip_distance_km": miles_to_km(F.col("trip_distance")),
        }
    )


def tagged_trips(raw: DataFrame, layout: str, year: int) -> DataFrame:
    """Every row with calendar columns, measures and its status; rejects included."""
    return with_measures(with_calendar(with_status(with_timestamps(raw, layout), year)))


def prepared_trips(raw: DataFrame, layout: str, year: int) -> DataFrame:
    """Kept rows with calendar columns and measures."""
    return tagged_trips(raw, layout, year).filter(F.col(STATUS) == KEPT).drop(STATUS)


def ingest_accounting(raw: DataFrame, layout: str, year: int) -> DataFrame:
    """Accounting straight from raw rows."""
    return accounting_of(with_status(with_timestamps(raw, layout), year))


def accounting_of(tagged: DataFrame) -> DataFrame:
    """Rows in, rows kept, rows rejected by cause and the kept time range, in one pass.

    Over a written table of tagged rows this reads the status and one column, so the raw text
    need not be parsed a second time.
    """
    kept = F.col(STATUS) == KEPT
    kept_pickup = F.when(kept, F.col("pickup_ts"))
    return tagged.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(kept).alias("prepared_rows"),
        F.count_if(F.col(STATUS) == NULL_PICKUP).alias("null_pickup_ts_rejected"),
        F.count_if(F.col(STATUS) == BAD_YEAR).alias("bad_year_rejected"),
        F.min(kept_pickup).alias("min_pickup_ts"),
        F.max(kept_pickup).alias("max_pickup_ts"),
    )


def zone_accounting(zones: DataFrame) -> DataFrame:
    """Rows of the zone table, those with an id, and ids that are listed more than once."""
    ids = zones.groupBy("location_id").agg(F.count("*").alias("entries"))
    known = F.col("location_id").isNotNull()
    return ids.agg(
        F.coalesce(F.sum("entries"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(known, F.col("entries"))), F.lit(0)).alias("prepared_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("entries"))), F.lit(0)).alias("null_id_rows"),
        F.count_if(known & (F.col("entries") > 1)).alias("repeated_ids"),
    )
