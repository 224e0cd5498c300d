"""Origin-destination change between the two halves of the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.functions.numbers import exact_avg, percent_change, rounded
from tripfold.operators.window import window_trips
from tripfold.params import (
    DEFAULT_PERIOD_K,
    DEFAULT_PERIOD_SUPPORT,
    DEFAULT_SPLIT_DAY,
    POSITIVE_PERIOD,
    TripWindow,
)
from tripfold.plans.ranking import top_k

PERIOD_WINDOW = TripWindow(days=None, hours=None, positive=POSITIVE_PERIOD)
KEYS = ("pu_location_id", "do_location_id", "pickup_hour")


def od_period_change(
    trips: DataFrame,
    window: TripWindow = PERIOD_WINDOW,
    split_day: int = DEFAULT_SPLIT_DAY,
    min_support: int = DEFAULT_PERIOD_SUPPORT,
    scale: int | None = None,
) -> DataFrame:
    """Both halves side by side per (pickup zone, dropoff zone, hour).

    One scan and one conditional aggregate, where joining two aggregates would scan and
    shuffle twice. Groups need ``min_support`` trips in either half. ``scale`` rounds the averages.
    """
    first = F.col("pickup_day") <= split_day
    second = F.col("pickup_day") > split_day
    groups = (
        window_trips(trips, window)
        .dropna(subset=list(KEYS))
        .groupBy(*KEYS)
        .agg(*_half("h1", first), *_half("h2", second))
    )
    return _changed(groups, min_support, scale)


def od_period_join(
    trips: DataFrame,
    window: TripWindow = PERIOD_WINDOW,
    split_day: int = DEFAULT_SPLIT_DAY,
    min_support: int = DEFAULT_PERIOD_SUPPORT,
    scale: int | None = None,
) -> DataFrame:
    """The same table from two aggregates and an inner join, kept to compare."""
    windowed = window_trips(trips, window)

    def half(suffix: str, rows: Column) -> DataFrame:
        return windowed.filter(rows).groupBy(*KEYS).agg(*_half(suffix, F.lit(True)))

    first = half("h1", F.col("pickup_day") <= split_day)
    second = half("h2", F.col("pickup_day") > split_day)
    return _changed(first.join(second, list(KEYS)), min_support, scale)


def _half(suffix: str, rows: Column) -> list[Column]:
    return [
        F.count_if(rows).alias(f"trips_{suffix}"),
        exact_avg(F.when(rows, F.col("fare_amount"))).alias(f"avg_fare_{suffix}"),
        exact_avg(F.when(rows, F.col("total_amount"))).alias(f"avg_total_{suffix}"),
    ]


def _changed(groups: DataFrame, min_support: int, scale: int | None) -> DataFrame:
    least = max(1, min_support)
    supported = groups.filter((F.col("trips_h1") >= least) & (F.col("trips_h2") >= least))

    def shown(name: str) -> Column:
        value = F.col(name)
        return (value if scale is None else rounded(value, scale)).alias(name)

    return supported.select(
        *KEYS,
        "trips_h1",
        shown("avg_fare_h1"),
        shown("avg_total_h1"),
        "trips_h2",
        shown("avg_fare_h2"),
        shown("avg_total_h2"),
        percent_change(F.col("trips_h1"), F.col("trips_h2")).alias("trips_change_pct"),
        percent_change(F.col("avg_fare_h1"), F.col("avg_fare_h2")).alias("fare_change_pct"),
    )


def largest_increases(change: DataFrame, k: int = DEFAULT_PERIOD_K) -> DataFrame:
    return top_k(change, k, F.desc("trips_change_pct"), ties=KEYS)


def largest_decreases(change: DataFrame, k: int = DEFAULT_PERIOD_K) -> DataFrame:
    return top_k(change, k, F.asc("trips_change_pct"), ties=KEYS)
