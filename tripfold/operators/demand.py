"""Temporal demand: busiest hours, time bands, weekdays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.functions.clock import is_weekend, time_band
from tripfold.functions.numbers import exact_sum, percent, rounded
from tripfold.operators.window import window_trips
from tripfold.params import DEFAULT_K, TripWindow
from tripfold.plans.ranking import top_k
from tripfold.plans.rollups import mean, merged_avg, merged_sum, partials, with_total
from tripfold.sources.prepare import prepared_trips


MEASURES = ("passenger_count", "duration_minutes", "trip_distance", "total_amount")


def demand_rollup(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Mergeable demand state per (date, hour, pickup zone).

    With the zone in the key, the distinct zones of an hour are a plain count one level up.
    """
    return (
        window_trips(trips, window)
        .groupBy("pickup_date", "pickup_hour", "pu_location_id")
        .agg(F.count("*").alias("trips"), *partials(MEASURES))
    )


def hourly_of(rollup: DataFrame) -> DataFrame:
    """Trips, reach and averages per (date, hour), with the share of the whole window."""
    groups = rollup.groupBy("pickup_date", "pickup_hour").agg(
        F.sum("trips").alias("trips"),
        F.count("pu_location_id").alias("unique_pickup_zones"),
        rounded(merged_avg("passenger_count"), 2).alias("avg_passenger_count"),
        rounded(merged_avg("duration_minutes"), 2).alias("avg_duration_minutes"),
        rounded(merged_avg("trip_distance"), 2).alias("avg_trip_distance"),
        rounded(merged_avg("total_amount"), 2).alias("avg_total_amount"),
        rounded(merged_sum("total_amount"), 2).alias("total_revenue"),
    )
    return with_total(groups, "trips", "window_trips").select(
        "pickup_date",
        "pickup_hour",
        time_band(F.col("pickup_hour")).alias("time_band"),
        "trips",
        "unique_pickup_zones",
        "avg_passenger_count",
        "avg_duration_minutes",
        "avg_trip_distance",
        "avg_total_amount",
        "total_revenue",
        percent(F.col("trips"), F.col("window_trips")).alias("trip_share_in_window"),
    )


def bands_of(rollup: DataFrame) -> DataFrame:
    """Trips and average amount per time band of any rollup by hour."""
    return (
        rollup.groupBy(time_band(F.col("pickup_hour")).alias("time_band"))
        .agg(
            F.sum("trips").alias("total_trips"),
            rounded(merged_avg("total_amount"), 2).alias("avg_total_amount"),
        )
        .orderBy(F.desc("total_trips"), "time_band")
    )


def demand_by_hour(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    return hourly_of(demand_rollup(trips, window))


def busiest(hourly: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Top rows of an hourly demand table: trips, then revenue, then earliest."""
    return top_k(
        hourly,
        k,
        F.desc("trips"),
        F.desc("total_revenue"),
        ties=("pickup_date", "pickup_hour"),
    )


def demand_topk(
    trips: DataFrame, window: TripWindow = TripWindow(), k: int = DEFAULT_K
) -> DataFrame:
    return busiest(demand_by_hour(trips, window), k)


def time_band_summary(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    by_hour = (
        window_trips(trips, window)
        .groupBy("pickup_hour")
        .agg(F.count("*").alias("trips"), *partials(["total_amount"]))
    )
    return bands_of(by_hour)


def weekend_profile(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Demand per weekday (1 = Sunday) with the weekend flag."""
    return (
        window_trips(trips, window)
        .groupBy(
            F.dayofweek("pickup_date").alias("weekday"),
            is_weekend(F.col("pickup_date")).alias("is_weekend"),
        )
        .agg(F.count("*").alias("trips"), mean("total_amount").alias("avg_total_amount"))
        .orderBy("weekday")
    )


ZONE_PIECE, ZONE_BITMAP = "zone_piece", "zone_bitmap"


def zone_bitmaps(trips: DataFrame, *keys: str) -> DataFrame:
    """Mergeable state of the distinct pickup zones per group: bitmaps of zone ids.

    A bitmap has 32,768 bits, 4 KB; ids beyond it go to further pieces of the group. Where sketches
    estimate, these count exactly, whatever windows are put together later.
    """
    zone = F.col("pu_location_id").cast("bigint")
    return (
        trips.filter(zone.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(zone).alias(ZONE_PIECE))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(zone)).alias(ZONE_BITMAP))
    )


def distinct_zones(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Distinct pickup zones per coarser group, from the bitmaps alone."""
    pieces = bitmaps.groupBy(*keys, ZONE_PIECE).agg(F.bitmap_or_agg(ZONE_BITMAP).alias(ZONE_BITMAP))
    return pieces.groupBy(*keys).agg(F.sum(F.bitmap_count(ZONE_BITMAP)).alias("unique_pickup_zones"))


def line_demand_topk(
    raw: DataFrame,
    layout: str,
    year: int,
    window: TripWindow = TripWindow(),
    k: int = DEFAULT_K,
) -> DataFrame:
    """Busiest hours straight from raw lines, trips and revenue only.

    Short or malformed lines read as nulls in the tested columns and drop out in the filters.
    """
    groups = (
        window_trips(prepared_trips(raw, layout, year), window)
        .groupBy("pickup_date", "pickup_hour")
        .agg(F.count("*").alias("trips"), rounded(exact_sum(F.col("total_amount")), 2).alias("total_revenue"))
    )
    return busiest(groups, k)
