"""Data profile: nulls, distributions, joinability, extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.functions.numbers import percent, unit_bucket
from tripfold.plans.dimensions import unique_zones
from tripfold.plans.heaps import Order, first_rows
from tripfold.plans.ranking import top_k

DISTANCE_SAMPLE = ("vendor_id", "pickup_ts", "trip_distance", "total_amount")
DURATION_SAMPLE = ("vendor_id", "pickup_ts", "duration_minutes", "trip_distance")
NEGATIVE_FARE_SAMPLE = ("vendor_id", "pickup_ts", "fare_amount", "total_amount")
ZERO_DURATION_SAMPLE = ("vendor_id", "pickup_ts", "duration_minutes", "total_amount")


def null_profile(frame: DataFrame) -> DataFrame:
    """Null percentage of every column, highest first; no rows for an empty input."""
    counts = frame.agg(
        F.count("*").alias("__rows"),
        *(F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in frame.columns),
    )
    return _null_shares(counts, frame.columns)


def _null_shares(counts: DataFrame, columns: list[str]) -> DataFrame:
    return (
        counts.unpivot("__rows", columns, "column_name", "nulls")
        .filter("__rows > 0")
        .select("column_name", percent(F.col("nulls"), F.col("__rows")).alias("null_pct"))
        .orderBy(F.desc("null_pct"), "column_name")
    )


# What the one scan of a profile groups by; the names tag the rows of its result.
NULLS, CALENDAR_AND_ZONES = "nulls", "calendar_and_zones"
ZONE_KEYS = ("pickup_day", "pickup_hour", "pu_location_id", "do_location_id")
MASK_BITS = 62


def tagged_counts(trips: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows by set of null columns, by day, hour and zones, and by bucket of each measure: one scan.

    A grouping set per section; ``section`` names it, the keys of the other sections are null and
    ``n`` is the only aggregate. The null columns of a row are bits of ``nulls_0``, ``nulls_1``
    and so on, so that their counts are a grouping like any other and follow from few groups.
    """
    masks = {}
    for start in range(0, len(trips.columns), MASK_BITS):
        bits = F.lit(0).cast("bigint")
        for place, name in enumerate(trips.columns[start : start + MASK_BITS]):
            bits = bits + F.when(F.col(f"`{name}`").isNull(), 1 << place).otherwise(0).cast("bigint")
        masks[f"nulls_{len(masks)}"] = bits
    buckets = {f"bucket_{name}": _held_bucket(F.col(name), *limits) for name, limits in ranges.items()}
    rows = trips.select(
        *ZONE_KEYS, *(key.alias(name) for name, key in {**masks, **buckets}.items())
    )
    sets = {NULLS: list(masks), CALENDAR_AND_ZONES: list(ZONE_KEYS)}
    sets |= {name: [f"bucket_{name}"] for name in ranges}
    keys = [key for section in sets.values() for key in section]
    # A set's id has the bits of the keys it leaves out, the last key lowest.
    section = F.lit(None).cast("string")
    for name, own in sets.items():
        absent = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in own)
        section = F.when(F.col("left_out") == absent, name).otherwise(section)
    counted = rows.groupingSets([[F.col(key) for key in own] for own in sets.values()], *keys).agg(
        F.grouping_id().alias("left_out"), F.count("*").alias("n")
    )
    return counted.withColumn("section", section).drop("left_out")


def section_of(counts: DataFrame, name: str, *keys: str) -> DataFrame:
    return counts.filter(F.col("section") == name).select(*keys, "n")


def null_profile_of(counts: DataFrame, columns: list[str]) -> DataFrame:
    """``null_profile`` from tagged counts of a frame with these columns."""
    rows = counts.filter(F.col("section") == NULLS)
    sums = []
    for place, name in enumerate(columns):
        bit = F.col(f"nulls_{place // MASK_BITS}").bitwiseAND(F.lit(1 << place % MASK_BITS))
        sums.append(F.sum(F.when(bit != 0, F.col("n")).otherwise(0)).alias(name))
    return _null_shares(rows.agg(F.sum("n").alias("__rows"), *sums), columns)


def trip_counts_of(counts: DataFrame) -> DataFrame:
    """Trips per day, hour and zone ids: what the distributions and zone tables derive from."""
    return section_of(counts, CALENDAR_AND_ZONES, *ZONE_KEYS)


def histogram_of(counts: DataFrame, column: str) -> DataFrame:
    """``histogram`` of a measure from tagged counts."""
    buckets = section_of(counts, column, F.col(f"bucket_{column}").alias("bucket"))
    return buckets.withColumnRenamed("n", "trips").orderBy("bucket")


def distribution(frame: DataFrame, key: str) -> DataFrame:
    """Rows per value of a column, in the order of the values."""
    return distribution_of(frame.groupBy(key).agg(F.count("*").alias("n")), key)


def distribution_of(counts: DataFrame, key: str) -> DataFrame:
    return counts.groupBy(key).agg(F.sum("n").alias("trips")).orderBy(key)


def hourly_distribution(trips: DataFrame) -> DataFrame:
    return distribution(trips, "pickup_hour")


def daily_distribution(trips: DataFrame) -> DataFrame:
    return distribution(trips, "pickup_day")


def joinability(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Share of trips whose zone id is in the dimension, for either end.

    Trips are counted per zone id before they meet the dimension, whose ids are made
    distinct first, so a repeated id cannot raise the share.
    """
    return joinability_of(trips.withColumn("n", F.lit(1)), zones)


def joinability_of(counts: DataFrame, zones: DataFrame) -> DataFrame:
    pickup, dropoff = F.col("pu_location_id"), F.col("do_location_id")
    ends = F.stack(F.lit(2), F.lit("pickup"), pickup, F.lit("dropoff"), dropoff)
    counted = (
        counts.select("n", ends.alias("endpoint", "location_id"))
        .groupBy("endpoint", "location_id")
        .agg(F.sum("n").alias("n"))
    )
    known = zones.select("location_id").distinct().withColumn("known", F.lit(True))
    unmatched = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0))
    return (
        counted.join(known, "location_id", "left")
        .groupBy("endpoint")
        .agg(F.sum("n").alias("trips"), unmatched.alias("unmatched"))
        .withColumn(
            "matched_pct", percent(F.col("trips") - F.col("unmatched"), F.col("trips"), 4)
        )
    )


def top_zones(trips: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    """Busiest pickup zones by name; ids without a zone count together under null."""
    return top_zones_of(trips.withColumn("n", F.lit(1)), zones, k)


def top_zones_of(counts: DataFrame, zones: DataFrame, k: int = 10) -> DataFrame:
    counted = counts.groupBy(F.col("pu_location_id").alias("location_id")).agg(
        F.sum("n").alias("n")
    )
    groups = (
        counted.join(unique_zones(zones).select("location_id", "zone"), "location_id", "left")
        .groupBy("zone")
        .agg(F.sum("n").alias("trips"))
    )
    return top_k(groups, k, F.desc("trips"), ties=("zone",))


def _held_bucket(value: Column, low: int, high: int) -> Column:
    bucket = unit_bucket(value)
    held = F.when(bucket < low, F.lit(low - 1)).when(bucket >= high, F.lit(high)).otherwise(bucket)
    return held.cast("bigint")


def histogram(frame: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Rows per unit bucket in [low, high); the rest counts in one bucket on either side.

    The bucket below is ``low - 1`` and the one above is ``high``, so no row is lost.
    """
    return (
        frame.groupBy(_held_bucket(F.col(column), low, high).alias("bucket"))
        .agg(F.count("*").alias("trips"))
        .orderBy("bucket")
    )


def bucket_counts(frame: DataFrame, column: str) -> DataFrame:
    """Rows per unit bucket, for every bucket that occurs; null values are not counted."""
    return (
        frame.filter(F.col(column).isNotNull())
        .groupBy(unit_bucket(F.col(column)).alias("bucket"))
        .agg(F.count("*").alias("trips"))
        .orderBy("bucket")
    )


def largest(frame: DataFrame, measure: str, columns: tuple[str, ...], k: int = 5) -> DataFrame:
    """The ``k`` rows with the highest value of a measure."""
    rest = tuple(name for name in columns if name != measure)
    return top_k(frame.select(*columns), k, F.desc(measure), ties=rest)


def sample_where(
    frame: DataFrame, condition: Column, columns: tuple[str, ...], k: int = 5
) -> DataFrame:
    """A repeatable sample of rows that meet a condition: the first ones by their own values."""
    return top_k(frame.filter(condition).select(*columns), k, ties=columns)


def negative_fares(trips: DataFrame, k: int = 5) -> DataFrame:
    return sample_where(trips, F.col("fare_amount") < 0, NEGATIVE_FARE_SAMPLE, k)


def zero_durations(trips: DataFrame, k: int = 5) -> DataFrame:
    return sample_where(trips, F.col("duration_minutes") == 0, ZERO_DURATION_SAMPLE, k)


# Sample by name: which rows it takes, the measure that leads its order, its columns.
SAMPLES = {
    "largest_distance": ("true", "trip_distance", DISTANCE_SAMPLE),
    "largest_duration": ("true", "duration_minutes", DURATION_SAMPLE),
    "negative_fare": ("fare_amount < 0", None, NEGATIVE_FARE_SAMPLE),
    "zero_duration": ("duration_minutes = 0", None, ZERO_DURATION_SAMPLE),
}


def extreme_samples(trips: DataFrame, k: int = 5) -> DataFrame:
    """The rows of all samples with the name of theirs, from one scan.

    Same rows as ``largest`` and ``sample_where`` take one by one: a task holds ``k`` rows a sample
    and sends no others.
    """
    orders = {}
    for name, (condition, lead, columns) in SAMPLES.items():
        leading = ((lead, True),) if lead else ()
        orders[name] = Order(
            F.expr(condition), leading + tuple((c, False) for c in columns if c != lead)
        )
    wanted = sorted({column for _, _, columns in SAMPLES.values() for column in columns})
    return first_rows(trips, orders, k, *wanted)


def sample_of(samples: DataFrame, name: str) -> DataFrame:
    return samples.filter(F.col("sample") == name).orderBy("place").select(*SAMPLES[name][2])
