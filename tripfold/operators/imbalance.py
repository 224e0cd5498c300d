"""Pickups against dropoffs per zone and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.operators.window import window_trips
from tripfold.params import DEFAULT_ACTIVITY, DEFAULT_K, POSITIVE_BALANCE, TripWindow
from tripfold.plans.dimensions import unique_zones
from tripfold.plans.ranking import top_k
from tripfold.plans.rollups import mean

BALANCE_WINDOW = TripWindow(positive=POSITIVE_BALANCE)


def zone_balance(trips: DataFrame, window: TripWindow = BALANCE_WINDOW) -> DataFrame:
    """Pickups and dropoffs per (hour, zone), from one scan and one aggregate.

    Each trip counts once for either end; both ends are dated by the pickup hour. Ends of an
    unknown zone stay apart by role, as an outer join of the two counts would leave them.
    """
    pickup, dropoff = F.col("pu_location_id"), F.col("do_location_id")
    ends = F.stack(F.lit(2), pickup, F.lit(1), dropoff, F.lit(0))
    unknown = F.col("location_id").isNull() | F.col("pickup_hour").isNull()
    counted = (
        window_trips(trips, window)
        .select("pickup_hour", ends.alias("location_id", "is_pickup"))
        .groupBy("pickup_hour", "location_id", F.when(unknown, F.col("is_pickup")).alias("role"))
        .agg(
            F.sum("is_pickup").alias("pickups"),
            F.sum(1 - F.col("is_pickup")).alias("dropoffs"),
        )
    )
    return _with_balance(counted.drop("role"))


def zone_balance_outer_join(trips: DataFrame, window: TripWindow = BALANCE_WINDOW) -> DataFrame:
    """The same table from two counts and a full outer join; two scans, kept to compare."""
    windowed = window_trips(trips, window)

    def counted(end: str, name: str) -> DataFrame:
        return windowed.groupBy("pickup_hour", F.col(end).alias("location_id")).agg(
            F.count("*").alias(name)
        )

    joined = counted("pu_location_id", "pickups").join(
        counted("do_location_id", "dropoffs"), ["pickup_hour", "location_id"], "full_outer"
    )
    return _with_balance(joined.fillna(0, ["pickups", "dropoffs"]))


def _with_balance(counted: DataFrame) -> DataFrame:
    activity = F.col("pickups") + F.col("dropoffs")
    net = F.col("pickups") - F.col("dropoffs")
    share = F.when(activity > 0, net / activity).otherwise(0.0)
    return counted.select(
        "pickup_hour",
        "location_id",
        "pickups",
        "dropoffs",
        activity.alias("activity"),
        net.alias("net_pickups"),
        share.alias("imbalance_ratio"),
        F.abs(share).alias("abs_imbalance_ratio"),
    )


def label_zones(balance: DataFrame, zones: DataFrame) -> DataFrame:
    """Add zone names; zones missing from the dimension keep their row."""
    names = unique_zones(zones).select("location_id", "borough", "zone", "service_zone")
    return balance.join(names, "location_id", "left").select(
        *balance.columns, "borough", "zone", "service_zone"
    )


def zone_imbalance(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = BALANCE_WINDOW,
    min_activity: int = DEFAULT_ACTIVITY,
) -> DataFrame:
    """Zone balance of the active zones, with names."""
    active = zone_balance(trips, window).filter(F.col("activity") >= min_activity)
    return label_zones(active, zones)


def zone_imbalance_outer_join(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = BALANCE_WINDOW,
    min_activity: int = DEFAULT_ACTIVITY,
) -> DataFrame:
    active = zone_balance_outer_join(trips, window).filter(F.col("activity") >= min_activity)
    return label_zones(active, zones)


def most_net_pickups(imbalance: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    return top_k(imbalance, k, F.desc("net_pickups"), ties=("pickup_hour", "location_id"))


def most_net_dropoffs(imbalance: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    return top_k(imbalance, k, F.asc("net_pickups"), ties=("pickup_hour", "location_id"))


def most_unbalanced(imbalance: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    return top_k(imbalance, k, F.desc("abs_imbalance_ratio"), ties=("pickup_hour", "location_id"))


def imbalance_hourly_of(balance: DataFrame) -> DataFrame:
    return (
        balance.groupBy("pickup_hour")
        .agg(
            F.sum(F.abs("net_pickups")).alias("total_abs_net_pickups"),
            mean("abs_imbalance_ratio", 4).alias("avg_abs_imbalance_ratio"),
        )
        .orderBy("pickup_hour")
    )


def imbalance_hourly(trips: DataFrame, window: TripWindow = BALANCE_WINDOW) -> DataFrame:
    """Summary per hour over all zones, whatever their activity."""
    return imbalance_hourly_of(zone_balance(trips, window))
