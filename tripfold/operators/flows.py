"""Origin-destination flows and trips touching special zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.functions.numbers import optional_amount, percent, rounded
from tripfold.operators.window import window_trips
from tripfold.params import DEFAULT_K, SpecialZones, TripWindow
from tripfold.plans.dimensions import join_zone, special_zones
from tripfold.plans.ranking import top_k
from tripfold.plans.rollups import merged_avg, merged_sum, partials, with_total

MEASURES = ("total_amount", "trip_distance", "duration_minutes", "fee")
FEE_PAID = "fee_paid"


def _join_both_ends(facts: DataFrame, zones: DataFrame, rule: SpecialZones) -> DataFrame:
    marked = special_zones(zones, rule)
    wanted = ("borough", "zone", "is_special")
    return join_zone(join_zone(facts, marked, "pu", *wanted), marked, "do", *wanted)


def _special_trip() -> Column:
    touched = F.col("pu_is_special") | F.col("do_is_special") | F.col(FEE_PAID)
    return F.when(touched, 1).otherwise(0)


def special_zone_trips(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    rule: SpecialZones = SpecialZones(),
) -> DataFrame:
    """Windowed trips, one row each, with both zones and the special-trip flag."""
    windowed = window_trips(trips, window)
    fee = optional_amount(windowed, "airport_fee")
    joined = _join_both_ends(windowed.withColumn(FEE_PAID, fee > 0), zones, rule)
    flagged = {
        "pu_is_airport": F.col("pu_is_special").cast("int"),
        "do_is_airport": F.col("do_is_special").cast("int"),
        "is_airport_trip": _special_trip(),
    }
    return joined.withColumns(flagged).drop("pu_is_special", "do_is_special", FEE_PAID)


def flow_rollup(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    rule: SpecialZones = SpecialZones(),
) -> DataFrame:
    """Mergeable flow state per (pickup zone, dropoff zone, fee paid), zones joined on.

    Everything the flag depends on is in the key, so the trips themselves never meet the
    dimension: at most two rows per zone pair do.
    """
    windowed = window_trips(trips, window)
    by_id = (
        windowed.withColumn("fee", optional_amount(windowed, "airport_fee"))
        .groupBy("pu_location_id", "do_location_id", (F.col("fee") > 0).alias(FEE_PAID))
        .agg(F.count("*").alias("trips"), *partials(MEASURES))
    )
    return _join_both_ends(by_id, zones, rule).withColumn("is_airport_trip", _special_trip())


def flows_of(rollup: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Busiest borough-to-borough flows of a flow rollup."""
    special = F.sum(F.col("trips") * F.col("is_airport_trip"))
    groups = rollup.groupBy("pu_borough", "do_borough").agg(
        F.sum("trips").alias("trips"),
        rounded(merged_sum("total_amount"), 2).alias("total_revenue"),
        rounded(merged_avg("total_amount"), 2).alias("avg_total_amount"),
        rounded(merged_avg("trip_distance"), 2).alias("avg_trip_distance"),
        rounded(merged_avg("duration_minutes"), 2).alias("avg_duration_minutes"),
        percent(special, F.sum("trips")).alias("airport_trip_share_percent"),
    )
    shared = with_total(groups, "trips", "all_trips").select(
        "pu_borough",
        "do_borough",
        "trips",
        percent(F.col("trips"), F.col("all_trips")).alias("trip_share_percent"),
        "total_revenue",
        "avg_total_amount",
        "avg_trip_distance",
        "avg_duration_minutes",
        "airport_trip_share_percent",
    )
    return top_k(shared, k, F.desc("trips"), ties=("pu_borough", "do_borough"))


def routes_of(rollup: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Busiest zone-to-zone routes among special trips of a flow rollup."""
    groups = (
        rollup.filter("is_airport_trip = 1")
        .groupBy("pu_zone", "do_zone")
        .agg(
            F.sum("trips").alias("trips"),
            rounded(merged_avg("fee"), 2).alias("avg_airport_fee"),
            rounded(merged_avg("total_amount"), 2).alias("avg_total_amount"),
            rounded(merged_avg("duration_minutes"), 2).alias("avg_duration_minutes"),
            rounded(merged_avg("trip_distance"), 2).alias("avg_trip_distance"),
        )
    )
    return top_k(groups, k, F.desc("trips"), ties=("pu_zone", "do_zone"))


def comparison_of(rollup: DataFrame) -> DataFrame:
    """Special against other trips of a flow rollup."""
    return rollup.groupBy("is_airport_trip").agg(
        F.sum("trips").alias("trips"),
        rounded(merged_avg("trip_distance"), 2).alias("avg_distance"),
        rounded(merged_avg("duration_minutes"), 2).alias("avg_duration"),
        rounded(merged_avg("total_amount"), 2).alias("avg_total_amount"),
    )


def flows_by_borough(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    rule: SpecialZones = SpecialZones(),
    k: int = DEFAULT_K,
) -> DataFrame:
    return flows_of(flow_rollup(trips, zones, window, rule), k)


def special_zone_routes(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    rule: SpecialZones = SpecialZones(),
    k: int = DEFAULT_K,
) -> DataFrame:
    return routes_of(flow_rollup(trips, zones, window, rule), k)


def special_zone_comparison(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    rule: SpecialZones = SpecialZones(),
) -> DataFrame:
    return comparison_of(flow_rollup(trips, zones, window, rule))


def pickup_zone_trips(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    strategy: str = "auto",
    checked: bool = False,
) -> DataFrame:
    """Windowed trips with their pickup zone, by a chosen join strategy."""
    return join_zone(
        window_trips(trips, window),
        zones,
        "pu",
        "borough",
        "zone",
        "service_zone",
        strategy=strategy,
        checked=checked,
    )
