"""Payment mix and tipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.functions.money import CARD, CASH, tip_rate, zero_tip_flag
from tripfold.functions.numbers import ratio, rounded
from tripfold.operators.window import window_trips
from tripfold.params import POSITIVE_PRICED, TripWindow
from tripfold.plans.rollups import merged_avg, partials, with_total

PAYMENT_WINDOW = TripWindow(positive=POSITIVE_PRICED)
ELECTRONIC_OR_CASH = (CARD, CASH)
MEASURES = (
    "fare_amount",
    "total_amount",
    "tip_amount",
    "tip_rate",
    "zero_tip",
    "trip_distance",
    "duration_minutes",
)


def paid_trips(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    return window_trips(trips, window).filter(F.col("payment_type").isin(*ELECTRONIC_OR_CASH))


def payment_counts(trips: DataFrame) -> DataFrame:
    """Card and cash trips over everything, without a window."""
    return (
        trips.filter(F.col("payment_type").isin(*ELECTRONIC_OR_CASH))
        .groupBy("payment_type")
        .agg(F.count("*").alias("trips"))
    )


def payment_rollup(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    """Mergeable payment state per (hour, vendor, payment type); serves all three tables."""
    return (
        paid_trips(trips, window)
        .withColumns({"tip_rate": tip_rate(), "zero_tip": zero_tip_flag()})
        .groupBy("pickup_hour", "vendor_id", "payment_type")
        .agg(F.count("*").alias("trips"), *partials(MEASURES))
    )


def hourly_of(rollup: DataFrame) -> DataFrame:
    """Averages per (hour, payment type) and the share of the type within its hour."""
    groups = rollup.groupBy("pickup_hour", "payment_type").agg(
        F.sum("trips").alias("trips"),
        rounded(merged_avg("fare_amount"), 2).alias("avg_fare_amount"),
        rounded(merged_avg("total_amount"), 2).alias("avg_total_amount"),
        rounded(merged_avg("tip_amount"), 2).alias("avg_tip_amount"),
        rounded(merged_avg("tip_rate"), 4).alias("tip_rate"),
        rounded(merged_avg("zero_tip"), 4).alias("zero_tip_share"),
        rounded(merged_avg("trip_distance"), 2).alias("avg_trip_distance"),
        rounded(merged_avg("duration_minutes"), 2).alias("avg_duration_minutes"),
    )
    share = rounded(ratio(F.col("trips"), F.col("hour_trips")), 4)
    return (
        with_total(groups, "trips", "hour_trips", within=("pickup_hour",))
        .select(
            "pickup_hour",
            "payment_type",
            "trips",
            share.alias("payment_share_in_hour"),
            "avg_fare_amount",
            "avg_total_amount",
            "avg_tip_amount",
            "tip_rate",
            "zero_tip_share",
            "avg_trip_distance",
            "avg_duration_minutes",
        )
        .orderBy("pickup_hour", "payment_type")
    )


def vendors_of(rollup: DataFrame) -> DataFrame:
    """Share of each payment type within its vendor."""
    groups = rollup.groupBy("vendor_id", "payment_type").agg(F.sum("trips").alias("trips"))
    share = rounded(ratio(F.col("trips"), F.col("vendor_trips")), 4)
    return (
        with_total(groups, "trips", "vendor_trips", within=("vendor_id",))
        .select("vendor_id", "payment_type", "trips", share.alias("payment_share"))
        .orderBy("vendor_id", "payment_type")
    )


def card_vs_cash_of(rollup: DataFrame) -> DataFrame:
    """Card and cash side by side per hour."""

    def trips_by(code: int) -> Column:
        return F.sum(F.when(F.col("payment_type") == code, F.col("trips")).otherwise(0))

    def average(code: int, name: str, scale: int = 2) -> Column:
        paid = F.col("payment_type") == code
        return rounded(merged_avg(name, paid), scale)

    return (
        rollup.groupBy("pickup_hour")
        .agg(
            trips_by(CARD).alias("card_trips"),
            trips_by(CASH).alias("cash_trips"),
            rounded(ratio(trips_by(CARD), F.sum("trips")), 4).alias("card_share"),
            average(CARD, "total_amount").alias("avg_total_card"),
            average(CASH, "total_amount").alias("avg_total_cash"),
            average(CARD, "fare_amount").alias("avg_fare_card"),
            average(CASH, "fare_amount").alias("avg_fare_cash"),
            average(CARD, "tip_rate", 4).alias("avg_tip_rate_card"),
        )
        .orderBy("pickup_hour")
    )


def payment_hourly(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    return hourly_of(payment_rollup(trips, window))


def vendor_payment_share(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    return vendors_of(payment_rollup(trips, window))


def payment_card_vs_cash(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    return card_vs_cash_of(payment_rollup(trips, window))
