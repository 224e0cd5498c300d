"""Calendar window and validity filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.params import TripWindow


def window_condition(window: TripWindow) -> Column:
    """Conjunction of plain comparisons, each of which can prune partitions or reach the scan."""
    condition = F.lit(True)
    if window.days is not None:
        condition = condition & F.col("pickup_day").isin(*window.days)
    if window.hours is not None:
        condition = condition & F.col("pickup_hour").isin(*window.hours)
    for name in window.positive:
        condition = condition & (F.col(name) > 0)
    return condition


def window_trips(trips: DataFrame, window: TripWindow) -> DataFrame:
    return trips.filter(window_condition(window))


def window_trips_unpruned(trips: DataFrame, window: TripWindow) -> DataFrame:
    """The same rows, with the day taken from the timestamp instead of the partition column.

    Kept to measure what partition pruning saves: every partition has to be read.
    """
    rest = TripWindow(days=None, hours=window.hours, positive=window.positive)
    kept = window_trips(trips, rest)
    if window.days is None:
        return kept
    return kept.filter(F.dayofmonth("pickup_ts").isin(*window.days))


def window_trips_by_calendar(
    trips: DataFrame, calendar: DataFrame, condition: Column, window: TripWindow
) -> DataFrame:
    """The trips of the days of a calendar that meet a condition on its attributes.

    ``calendar`` has a row per ``pickup_day`` of the table. Which days count is known when the query
    runs: Spark then filters the partitions by the calendar rows it has broadcast for the
    join (dynamic partition pruning), so the files of other days are not opened. Hours and measures
    are filtered as in ``window_trips``; the window's own days are not looked at.
    """
    days = calendar.filter(condition).select("pickup_day")
    rest = TripWindow(days=None, hours=window.hours, positive=window.positive)
    return window_trips(trips, rest).join(days, "pickup_day", "left_semi")
