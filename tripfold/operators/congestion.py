"""Distance, speed and congestion by hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfold.functions import geo
from tripfold.functions.clock import in_year
from tripfold.functions.numbers import MEASURE, ratio, rounded
from tripfold.operators.window import window_trips
from tripfold.params import POSITIVE_ROUTE, BoundingBox, TripWindow
from tripfold.plans.rollups import mean, merged_avg, merged_sum, partials

CONGESTION_WINDOW = TripWindow(positive=("duration_minutes",))
COUNT, RUNNING, WHOLE = "rows__n", "rows__running", "rows__whole"
ROUTE_WINDOW = TripWindow(days=None, positive=POSITIVE_ROUTE)


def with_haversine(
    trips: DataFrame,
    window: TripWindow = CONGESTION_WINDOW,
    form=geo.haversine_km,
) -> DataFrame:
    """Windowed trips with real coordinates and their great-circle distance.

    ``form`` picks the expression: native arctangent, native arcsine or the Arrow batch one.
    """
    distance = form(*(F.col(name) for name in geo.COORDINATES))
    return (
        window_trips(trips, window)
        .filter(geo.has_coordinates())
        .withColumn("haversine_km", distance)
    )


def congestion_by_hour(
    trips: DataFrame,
    window: TripWindow = CONGESTION_WINDOW,
    slow_below_kmh: float = 15.0,
    form=geo.haversine_km,
) -> DataFrame:
    """Straight-line distance and speed per hour and the share of slow trips."""
    speed = geo.speed_kmh(F.col("haversine_km"), F.col("duration_minutes"))
    return (
        with_haversine(trips.filter(geo.moved() & (F.col("duration_minutes") > 0)), window, form)
        .withColumn("speed_kmh", speed)
        .withColumn("slow", geo.slow_flag(F.col("speed_kmh"), slow_below_kmh))
        .groupBy("pickup_hour")
        .agg(
            F.count("*").alias("total_trips"),
            mean("haversine_km", grain=MEASURE).alias("avg_distance_km"),
            mean("speed_kmh", grain=MEASURE).alias("avg_speed_kmh"),
            rounded(F.avg("slow") * 100, 2).alias("congestion_percentage"),
        )
        .orderBy("pickup_hour")
    )


def route_quality_by_hour(
    trips: DataFrame,
    window: TripWindow = ROUTE_WINDOW,
    year: int | None = None,
    box: BoundingBox = BoundingBox(),
    slow_below_kmh: float = 10.0,
    slow_from_km: float = 1.0,
    scale: int | None = None,
) -> DataFrame:
    """Metered against straight-line distance per hour: speed, detour, slow share.

    Trips collapse to counts and sums per hour and duration, so that the exact percentiles and
    everything else come from one scan. ``scale`` rounds the measures; by default they stay as
    computed.
    """
    kept = (
        window_trips(trips, window)
        .filter(F.col("pickup_ts").isNotNull() & F.col("dropoff_ts").isNotNull())
        .filter(geo.within(box))
    )
    if year is not None:
        kept = kept.filter(in_year(F.col("pickup_ts"), year))
    metered, straight, speed = F.col("metered_km"), F.col("straight_km"), F.col("speed_kmh")
    measured = (
        kept.withColumns(
            {
                "metered_km": geo.miles_to_km(F.col("trip_distance")),
                "straight_km": geo.haversine_asin_km(*(F.col(c) for c in geo.COORDINATES)),
                "duration": F.col("duration_minutes"),
            }
        )
        .withColumn("speed_kmh", ratio(metered, F.col("duration_minutes") / F.lit(60.0)))
        .withColumns(
            {
                "detour": geo.detour_ratio(metered, straight),
                "slow": geo.slow_flag(speed, slow_below_kmh, metered, slow_from_km),
            }
        )
    )
    measures = ("duration", "speed_kmh", "metered_km", "straight_km", "detour")
    counted = measured.groupBy("pickup_hour", "duration_minutes").agg(
        F.count("*").alias(COUNT), F.sum("slow").alias("slow"), *partials(measures, MEASURE)
    )

    def shown(value: Column) -> Column:
        return value if scale is None else rounded(value, scale)

    def total(name: str) -> Column:
        return merged_sum(name, grain=MEASURE)

    def average(name: str) -> Column:
        return shown(merged_avg(name, grain=MEASURE))

    rows = F.sum(COUNT)
    return (
        with_ranks(counted, "pickup_hour", "duration_minutes")
        .groupBy("pickup_hour")
        .agg(
            rows.alias("trips"),
            average("duration").alias("avg_duration_minutes"),
            shown(discrete_percentile("duration_minutes", 0.5)).alias("median_duration_minutes"),
            shown(discrete_percentile("duration_minutes", 0.9)).alias("p90_duration_minutes"),
            average("speed_kmh").alias("avg_speed_kmh"),
            shown(ratio(total("metered_km"), total("duration") / 60)).alias("agg_speed_kmh"),
            average("straight_km").alias("avg_haversine_km"),
            shown(ratio(total("metered_km") - total("straight_km"), rows)).alias("avg_distance_gap_km"),
            average("detour").alias("avg_detour_ratio"),
            shown(ratio(F.sum("slow"), rows)).alias("congestion_candidate_share"),
        )
        .orderBy("pickup_hour")
    )


def duration_percentiles(trips: DataFrame, window: TripWindow = ROUTE_WINDOW) -> DataFrame:
    """Exact median and 90th percentile of the duration per hour."""
    counted = (
        window_trips(trips, window)
        .filter(F.col("duration_minutes").isNotNull())
        .groupBy("pickup_hour", "duration_minutes")
        .agg(F.count("*").alias(COUNT))
    )
    return (
        with_ranks(counted, "pickup_hour", "duration_minutes")
        .groupBy("pickup_hour")
        .agg(
            discrete_percentile("duration_minutes", 0.5).alias("median_duration_minutes"),
            discrete_percentile("duration_minutes", 0.9).alias("p90_duration_minutes"),
        )
        .orderBy("pickup_hour")
    )


# Larger sketches err less: at 400 the rank of a quantile is off by less than one percent of the
# rows with 99 % confidence.
SKETCH_K = 400
RANK_ERROR = 0.01


def sketches(frame: DataFrame, measure: str, *keys: str) -> DataFrame:
    """Mergeable quantile state of a continuous measure per group: a KLL sketch of a few kilobytes.

    Durations are whole seconds and are counted by value for exact percentiles; distances
    and speeds hardly repeat, so their counts would be as large as the trips. NaN is not counted.
    """
    value = F.col(measure).cast("double")
    held = frame.filter(value.isNotNull() & ~F.isnan(value))
    return held.groupBy(*keys).agg(
        F.count("*").alias(COUNT), F.kll_sketch_agg_double(value, F.lit(SKETCH_K)).alias("sketch")
    )


def sketched_percentiles(state: DataFrame, shares: tuple[float, ...], *keys: str) -> DataFrame:
    """Quantiles of coarser groups, one row a share, from merged sketches; no trips are read."""
    merged = state.groupBy(*keys).agg(
        F.sum(COUNT).alias("trips"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch")
    )
    found = [
        F.struct(F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(s)).alias("quantile"))
        for s in shares
    ]
    return merged.select(*keys, "trips", F.inline(F.array(*found)))


def with_ranks(counted: DataFrame, group: str, value: str) -> DataFrame:
    """Add the running and the whole count of the group, in the order of the values.

    Takes counts per group and value, not trips: durations are whole seconds, so a group has few.
    """
    within = Window.partitionBy(group)
    return counted.withColumns(
        {
            RUNNING: F.sum(COUNT).over(within.orderBy(value)),
            WHOLE: F.sum(COUNT).over(within),
        }
    )


def discrete_percentile(value: str, share: float) -> Column:
    """The least value that at least ``share`` of the rows do not exceed."""
    return F.min(F.when(F.col(RUNNING) >= F.lit(share) * F.col(WHOLE), F.col(value)))
