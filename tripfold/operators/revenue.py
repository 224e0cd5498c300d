"""Revenue and efficiency by pickup zone and distance bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.functions.money import distance_bucket, surcharge_total
from tripfold.functions.numbers import optional_amount, rounded
from tripfold.operators.window import window_trips
from tripfold.params import (
    DEFAULT_K,
    DEFAULT_SUPPORT,
    POSITIVE_PRICED,
    POSITIVE_ROUTE,
    AdaptiveSupport,
    TripWindow,
)
from tripfold.plans.dimensions import join_zone
from tripfold.plans.ranking import top_k
from tripfold.plans.rollups import (
    merged_avg,
    merged_ratio,
    merged_sum,
    partials,
    with_total,
)
from tripfold.schemas import SURCHARGES

REVENUE_WINDOW = TripWindow(positive=POSITIVE_PRICED)
MEASURES = (
    "total_amount",
    "trip_distance",
    "duration_minutes",
    "fare_amount",
    "tip_amount",
    "surcharges",
)
THRESHOLD = "support_threshold"
GROUP_KEYS = ("pickup_borough", "pickup_zone", "distance_bucket")


def surcharge_components(trips: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, every surcharge component with null as zero, and their total."""
    return trips.select(
        *keep,
        *(optional_amount(trips, name).alias(name) for name in SURCHARGES),
        surcharge_total(trips).alias("surcharge_total"),
    )


def revenue_by_zone_bucket(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = REVENUE_WINDOW,
    min_support: int | AdaptiveSupport = 0,
) -> DataFrame:
    """Revenue measures per (borough, zone, distance bucket) of at least ``min_support`` trips.

    The support is a fixed number, or a rule that follows the number of windowed trips,
    counted before the zone join.
    """
    return supported(revenue_with_threshold(trips, zones, window, min_support))


def supported(groups: DataFrame) -> DataFrame:
    """Groups that reach the threshold they carry."""
    return groups.filter(F.col("trips") >= F.col(THRESHOLD)).drop(THRESHOLD)


def revenue_with_threshold(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = REVENUE_WINDOW,
    min_support: int | AdaptiveSupport = 0,
) -> DataFrame:
    """All groups, each with the support threshold in a column."""
    windowed = window_trips(trips, window)
    adaptive = isinstance(min_support, AdaptiveSupport)
    by_id = (
        windowed.withColumns(
            {
                "distance_bucket": distance_bucket(F.col("trip_distance")),
                "surcharges": surcharge_total(windowed),
            }
        )
        .groupBy("pu_location_id", "distance_bucket")
        .agg(F.count("*").alias("trips"), *partials(MEASURES))
    )
    # The adaptive rule counts trips of unknown zones too: they stay, as a group of their own,
    # until the total over the named groups is taken.
    flagged = zones.withColumn("known", F.lit(True))
    named = join_zone(
        by_id, flagged, "pu", "borough", "zone", "known", how="left" if adaptive else "inner"
    )
    groups = (
        named.withColumnsRenamed({"pu_borough": "pickup_borough", "pu_zone": "pickup_zone"})
        .groupBy(*GROUP_KEYS, "pu_known")
        .agg(
            F.sum("trips").alias("trips"),
            rounded(merged_sum("total_amount"), 2).alias("total_revenue"),
            rounded(merged_avg("total_amount"), 2).alias("avg_revenue_per_trip"),
            rounded(merged_ratio("total_amount", "trip_distance"), 2).alias("revenue_per_mile"),
            rounded(merged_ratio("total_amount", "duration_minutes"), 2).alias(
                "revenue_per_minute"
            ),
            rounded(merged_avg("fare_amount"), 2).alias("avg_fare_amount"),
            rounded(merged_avg("tip_amount"), 2).alias("avg_tip_amount"),
            rounded(merged_ratio("surcharges", "total_amount"), 4).alias("surcharge_share"),
        )
    )
    threshold = F.lit(min_support) if not adaptive else _threshold(F.col("window_trips"), min_support)
    if adaptive:
        groups = with_total(groups, "trips", "window_trips")
    return (
        groups.filter("pu_known")
        .withColumn(THRESHOLD, threshold.cast("bigint"))
        .drop("pu_known", "window_trips")
    )


def _threshold(window_trips: Column, rule: AdaptiveSupport) -> Column:
    wanted = F.floor(window_trips * F.lit(rule.share))
    return F.greatest(F.lit(rule.low), F.least(F.lit(rule.high), wanted))


def revenue_ranked(groups: DataFrame, measure: str, k: int = DEFAULT_K) -> DataFrame:
    """Top groups by one measure of a revenue table."""
    return top_k(groups, k, F.desc(measure), ties=GROUP_KEYS)


def revenue_topk(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = REVENUE_WINDOW,
    measure: str = "total_revenue",
    k: int = DEFAULT_K,
    min_support: int | AdaptiveSupport = DEFAULT_SUPPORT,
) -> DataFrame:
    groups = revenue_by_zone_bucket(trips, zones, window, min_support)
    return revenue_ranked(groups, measure, k)


def zone_revenue(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(positive=POSITIVE_ROUTE),
) -> DataFrame:
    """Trips and revenue per pickup zone name."""
    return zone_revenue_of(window_trips(trips, window), zones)


def zone_revenue_of(windowed: DataFrame, zones: DataFrame) -> DataFrame:
    by_id = windowed.groupBy("pu_location_id").agg(
        F.count("*").alias("trips"), *partials(["total_amount"])
    )
    return (
        join_zone(by_id, zones, "pu", "zone")
        .groupBy(F.col("pu_zone").alias("zone"))
        .agg(
            F.sum("trips").alias("trips"),
            rounded(merged_sum("total_amount"), 2).alias("revenue"),
        )
    )
