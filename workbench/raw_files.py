"""Raw files derived from the given tables, so the readers have something real to read.

Spark writes each copy once per session and input folder, in a fresh folder of the shared
place; no row passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripfold.operators import demand
from tripfold.plans.buckets import write_bucketed
from tripfold.plans.dimensions import unique_zones
from tripfold.schemas import TRIPS_ZONED_RAW
from tripfold.sources.staging import new_folder
from tripfold.sources.writers import replace_partitions, write_rebalanced, write_table
from workbench import tables

# Every so many orders get a pickup time that does not parse, to exercise the rejects.
UNPARSABLE_EVERY = 97
UNPARSABLE = "not a time"
# Every so many zones get an id that is not a number.
BAD_ZONE_EVERY = 10

# A packed file is read by one task, so files are kept small.
PACKED_CSV = {"header": True, "compression": "gzip", "maxRecordsPerFile": 250_000}

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        path = f"{new_folder(spark, kind)}/data"
        write(path)
        _written[key] = path
    return _written[key]


def _seconds_text(name: str, separator: str, end: str) -> Column:
    """Wall-clock text to the second; formatting functions would go through the session zone."""
    text = F.substring(F.col(name).cast("string"), 1, 19)
    return F.concat(F.translate(text, " ", separator), F.lit(end))


def _time_texts(separator: str, end: str) -> list[Column]:
    unparsable = F.col("l_orderkey") % UNPARSABLE_EVERY == 0
    pickup = F.when(unparsable, UNPARSABLE).otherwise(_seconds_text("pickup_ts", separator, end))
    return [
        pickup.alias("tpep_pickup_datetime"),
        _seconds_text("dropoff_ts", separator, end).alias("tpep_dropoff_datetime"),
    ]


def _blank(type_name: str, name: str) -> Column:
    return F.lit(None).cast(type_name).alias(name)


def zoned_csv(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        tables.trips(spark, sf_dir).select(
            F.col("vendor_id").alias("VendorID"),
            *_time_texts("T", ".000"),
            "passenger_count",
            "trip_distance",
            _blank("int", "RatecodeID"),
            _blank("string", "store_and_fwd_flag"),
            F.col("pu_location_id").alias("PULocationID"),
            F.col("do_location_id").alias("DOLocationID"),
            "payment_type",
            "fare_amount",
            "extra",
            "mta_tax",
            "tip_amount",
            "tolls_amount",
            "improvement_surcharge",
            "total_amount",
            "congestion_surcharge",
            F.col("airport_fee").alias("Airport_fee"),
        ).write.options(**PACKED_CSV).csv(path)

    return _once(spark, sf_dir, "zoned-csv", write)


# What is wrong with the lines of every so many orders, first match first.
FAULTS = {"blank": 109, "short": 101, "long": 103, "distance": 89, "passengers": 83, "no_time": 107, "time": 97}
SHORT_FIELDS = 10


def faulty_lines(spark: SparkSession, sf_dir: str) -> str:
    """Zoned trips as text with lines of every fault, the header in a file of its own."""

    def hit(fault: str) -> Column:
        return F.col("l_orderkey") % FAULTS[fault] == 0

    def write(path: str) -> None:
        pickup = F.when(hit("no_time"), "").when(hit("time"), UNPARSABLE)
        known = {
            "VendorID": F.col("vendor_id"),
            "tpep_pickup_datetime": pickup.otherwise(_seconds_text("pickup_ts", "T", ".000")),
            "tpep_dropoff_datetime": _seconds_text("dropoff_ts", "T", ".000"),
            "passenger_count": F.when(hit("passengers"), "two").otherwise(F.col("passenger_count").cast("string")),
            "trip_distance": F.when(hit("distance"), "far").otherwise(F.col("trip_distance").cast("string")),
            "store_and_fwd_flag": F.lit('"N, quoted"'),
            "PULocationID": F.col("pu_location_id"),
            "DOLocationID": F.col("do_location_id"),
            "payment_type": F.col("payment_type"),
            "total_amount": F.col("total_amount"),
        }
        names = StructType.fromDDL(TRIPS_ZONED_RAW).names
        fields = [F.coalesce(known.get(name, F.lit("")).cast("string"), F.lit("")) for name in names]
        line = F.concat_ws(",", *fields)
        faulty = (
            F.when(hit("blank"), "")
            .when(hit("short"), F.substring_index(line, ",", SHORT_FIELDS))
            .when(hit("long"), F.concat(line, F.lit(",more")))
            .otherwise(line)
        )
        tables.trips(spark, sf_dir).select(faulty.alias("value")).write.text(f"{path}/lines")
        spark.range(1).select(F.lit(",".join(names))).write.text(f"{path}/header")

    return _once(spark, sf_dir, "faulty-lines", write) + "/*"


def months_replaced(spark: SparkSession, sf_dir: str) -> str:
    """Trips by year and month, of which one year was written again, in part and then in whole."""

    def write(path: str) -> None:
        parts = {"pickup_year": F.year("pickup_ts"), "pickup_month": F.month("pickup_ts")}
        trips = tables.trips(spark, sf_dir).withColumns(parts)
        year = F.col("pickup_year") == 1998
        replace_partitions(trips, path, *parts)
        for part in (trips.filter("pickup_month <= 6 AND l_linenumber = 1"), trips.filter("pickup_month > 3")):
            replace_partitions(part.filter(year), path, *parts, within=year)

    return _once(spark, sf_dir, "months-replaced", write)


def gps_csv(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        tables.trips(spark, sf_dir).select(
            F.col("vendor_id").alias("VendorID"),
            *_time_texts(" ", ""),
            "passenger_count",
            "trip_distance",
            "pickup_longitude",
            "pickup_latitude",
            _blank("int", "RateCodeID"),
            _blank("string", "store_and_fwd_flag"),
            "dropoff_longitude",
            "dropoff_latitude",
            "payment_type",
            "fare_amount",
            "extra",
            "mta_tax",
            "tip_amount",
            "tolls_amount",
            "improvement_surcharge",
            "total_amount",
        ).write.options(**PACKED_CSV).csv(path)

    return _once(spark, sf_dir, "gps-csv", write)


def zones_csv(spark: SparkSession, sf_dir: str) -> str:
    location = F.col("location_id")

    def write(path: str) -> None:
        tables.zones(spark, sf_dir).select(
            F.when(location % BAD_ZONE_EVERY == 3, "N/A")
            .otherwise(location.cast("string"))
            .alias("LocationID"),
            F.col("borough").alias("Borough"),
            F.col("zone").alias("Zone"),
            "service_zone",
        ).write.option("header", True).csv(path)

    return _once(spark, sf_dir, "zones-csv", write)


def trips_by_day(spark: SparkSession, sf_dir: str) -> str:
    """Prepared trips as a Parquet table partitioned by day of month."""

    def write(path: str) -> None:
        # The sources are moved, less than half as wide as the trips that are made of them.
        sources = tables.trip_sources(spark, sf_dir)
        pickup = next(column for column in tables.TRIP_COLUMNS if column.endswith(" AS pickup_ts"))
        days = sources.selectExpr("*", pickup).withColumn("day", F.dayofmonth("pickup_ts")).drop("pickup_ts")
        trips = tables.made_trips(days.hint("rebalance", "day"))
        write_rebalanced(trips, path, "pickup_day", sort_within=("pickup_hour",))

    return _once(spark, sf_dir, "trips-by-day", write)


def calendar(spark: SparkSession, sf_dir: str) -> str:
    """A row per day of month the trips have, with the part of the month it is in."""

    def write(path: str) -> None:
        day = F.col("pickup_day")
        part = F.when(day < 12, "early").when(day <= 14, "middle").otherwise("late")
        counted = tables.trips(spark, sf_dir).groupBy("pickup_day").agg(F.count("*").alias("trips"))
        write_table(counted.withColumn("part_of_month", part), path)

    return _once(spark, sf_dir, "calendar", write)


BUCKETS = 8


def bucketed_trips(spark: SparkSession, sf_dir: str) -> str:
    """Name of a table of trips bucketed by pickup zone; the zones beside it are ``…_zones``."""

    def write(path: str) -> None:
        name = table_name(path)
        write_bucketed(tables.trips(spark, sf_dir), name, path, BUCKETS, "pu_location_id")
        write_bucketed(unique_zones(tables.zones(spark, sf_dir)), f"{name}_zones", f"{path}-zones", BUCKETS, "location_id")

    return table_name(_once(spark, sf_dir, "bucketed", write))


def table_name(path: str) -> str:
    return path.rstrip("/").split("/")[-2].replace("-", "_")


def zone_bitmaps(spark: SparkSession, sf_dir: str) -> str:
    """Bitmaps of pickup zones per date and hour, written once for all windows."""

    def write(path: str) -> None:
        write_table(demand.zone_bitmaps(tables.trips(spark, sf_dir), "pickup_date", "pickup_day", "pickup_hour"), path)

    return _once(spark, sf_dir, "zone-bitmaps", write)


def zones_table(spark: SparkSession, sf_dir: str) -> str:
    """Zones as plain Parquet, written over an earlier table of twice the rows."""

    def write(path: str) -> None:
        zones = tables.zones(spark, sf_dir)
        write_table(zones.union(zones), path)
        write_table(zones, path)

    return _once(spark, sf_dir, "zones-table", write)


def report_folder(spark: SparkSession) -> str:
    return new_folder(spark, "report")


def read_trips_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(trips_by_day(spark, sf_dir))
