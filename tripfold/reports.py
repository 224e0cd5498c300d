"""The result tables of each question, from as few scans of the trips as possible.

Where several tables come from the same groups, the groups are written once under the
output folder and the tables start from there: the trips are read once, and a lost executor
costs the small read, not the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripfold.operators import (
    congestion,
    demand,
    flows,
    imbalance,
    payments,
    periods,
    profile,
    revenue,
)
from tripfold.params import (
    DEFAULT_ACTIVITY,
    DEFAULT_AMOUNT_RANGE,
    DEFAULT_DISTANCE_RANGE,
    DEFAULT_K,
    DEFAULT_PERIOD_K,
    DEFAULT_PERIOD_SUPPORT,
    DEFAULT_SPLIT_DAY,
    POSITIVE_BALANCE,
    POSITIVE_PRICED,
    AdaptiveSupport,
    BoundingBox,
    SpecialZones,
    TripWindow,
)
from tripfold.sources.staging import materialised

Sections = dict[str, DataFrame]


def demand_report(
    trips: DataFrame, window: TripWindow, folder: str, k: int = DEFAULT_K
) -> Sections:
    rollup = materialised(demand.demand_rollup(trips, window), f"{folder}/_rollup")
    return {
        "top_demand_hours": demand.busiest(demand.hourly_of(rollup), k),
        "time_band_summary": demand.bands_of(rollup),
    }


def congestion_report(
    trips: DataFrame, window: TripWindow, slow_below_kmh: float = 15.0
) -> Sections:
    return {"hourly_metrics": congestion.congestion_by_hour(trips, window, slow_below_kmh)}


def route_quality_report(
    trips: DataFrame,
    window: TripWindow,
    year: int | None = None,
    box: BoundingBox = BoundingBox(),
    slow_below_kmh: float = 10.0,
    slow_from_km: float = 1.0,
) -> Sections:
    summary = congestion.route_quality_by_hour(
        trips, window, year, box, slow_below_kmh, slow_from_km
    )
    return {"summary": summary}


def revenue_report(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow,
    folder: str,
    k: int = DEFAULT_K,
    min_support: int | AdaptiveSupport = AdaptiveSupport(),
) -> Sections:
    window = window.requiring(POSITIVE_PRICED)
    groups = materialised(
        revenue.revenue_with_threshold(trips, zones, window, min_support), f"{folder}/_groups"
    )
    supported = revenue.supported(groups)
    everything = groups.drop(revenue.THRESHOLD)
    return {
        "support_threshold": groups.select(revenue.THRESHOLD).limit(1),
        "extreme_without_support": revenue.revenue_ranked(everything, "revenue_per_mile", 1),
        "top_by_total_revenue": revenue.revenue_ranked(supported, "total_revenue", k),
        "top_by_revenue_per_mile": revenue.revenue_ranked(supported, "revenue_per_mile", k),
        "top_by_revenue_per_minute": revenue.revenue_ranked(supported, "revenue_per_minute", k),
    }


def payment_report(trips: DataFrame, window: TripWindow, folder: str) -> Sections:
    window = window.requiring(POSITIVE_PRICED)
    rollup = materialised(payments.payment_rollup(trips, window), f"{folder}/_rollup")
    return {
        "hourly_payment_stats": payments.hourly_of(rollup),
        "vendor_summary": payments.vendors_of(rollup),
        "card_vs_cash_comparison": payments.card_vs_cash_of(rollup),
    }


def flow_report(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow,
    folder: str,
    rule: SpecialZones = SpecialZones(),
    k: int = DEFAULT_K,
) -> Sections:
    rollup = materialised(flows.flow_rollup(trips, zones, window, rule), f"{folder}/_rollup")
    return {
        "airport_vs_other_comparison": flows.comparison_of(rollup),
        "top_borough_flows": flows.flows_of(rollup, k),
        "top_airport_routes": flows.routes_of(rollup, k),
    }


def imbalance_report(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow,
    folder: str,
    min_activity: int = DEFAULT_ACTIVITY,
    k: int = DEFAULT_K,
) -> Sections:
    window = window.requiring(POSITIVE_BALANCE)
    balance = materialised(imbalance.zone_balance(trips, window), f"{folder}/_balance")
    active = imbalance.label_zones(balance.filter(balance.activity >= min_activity), zones)
    return {
        "top_positive_net_pickups": imbalance.most_net_pickups(active, k),
        "top_negative_net_pickups": imbalance.most_net_dropoffs(active, k),
        "top_abs_imbalance_ratio": imbalance.most_unbalanced(active, k),
        "hourly_summary": imbalance.imbalance_hourly_of(balance),
    }


def period_report(
    trips: DataFrame,
    folder: str,
    min_support: int = DEFAULT_PERIOD_SUPPORT,
    k: int = DEFAULT_PERIOD_K,
    split_day: int = DEFAULT_SPLIT_DAY,
) -> Sections:
    change = materialised(
        periods.od_period_change(trips, split_day=split_day, min_support=min_support),
        f"{folder}/_change",
    )
    return {
        "top_increases": periods.largest_increases(change, k),
        "top_decreases": periods.largest_decreases(change, k),
    }


def profile_report(
    trips: DataFrame,
    zones: DataFrame,
    folder: str,
    distance_range: tuple[int, int] = DEFAULT_DISTANCE_RANGE,
    amount_range: tuple[int, int] = DEFAULT_AMOUNT_RANGE,
) -> Sections:
    """Two scans of the trips: all counts by grouping sets, and the samples."""
    ranges = {"trip_distance": distance_range, "total_amount": amount_range}
    counts = materialised(profile.tagged_counts(trips, ranges), f"{folder}/_counts")
    samples = materialised(profile.extreme_samples(trips), f"{folder}/_samples")
    by_zone = profile.trip_counts_of(counts)
    return {
        "null_percentages": profile.null_profile_of(counts, trips.columns),
        "hourly_distribution": profile.distribution_of(by_zone, "pickup_hour"),
        "daily_distribution": profile.distribution_of(by_zone, "pickup_day"),
        "joinability": profile.joinability_of(by_zone, zones),
        "top_pickup_zones": profile.top_zones_of(by_zone, zones),
        "trip_distance_histogram": profile.histogram_of(counts, "trip_distance"),
        "total_amount_histogram": profile.histogram_of(counts, "total_amount"),
        **{name: profile.sample_of(samples, name) for name in profile.SAMPLES},
    }
