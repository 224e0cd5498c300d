"""One query per operator, from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripfold import schemas
from tripfold.functions import clock, geo
from tripfold.functions.numbers import exact_sum, rounded
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
from tripfold.operators.window import window_trips, window_trips_by_calendar, window_trips_unpruned
from tripfold.params import (
    POSITIVE_BALANCE,
    POSITIVE_PRICED,
    POSITIVE_ROUTE,
    AdaptiveSupport,
    BoundingBox,
    SpecialZones,
    TripWindow,
)
from tripfold.sources import prepare, readers, screen, writers
from tripfold.sql import variants
from workbench import raw_files
from workbench.tables import table, trips, zones

Query = Callable[[SparkSession, str], DataFrame]

# Parameters sized for the given tables; the oracle text repeats them on purpose.
NARROW = TripWindow()
HOURS = TripWindow(days=None)
PRICED = HOURS.requiring(POSITIVE_PRICED)
BALANCE = HOURS.requiring(POSITIVE_BALANCE)
ROUTE = HOURS.requiring(POSITIVE_ROUTE)
SPECIAL = SpecialZones(pattern="nation_(7|12)$", boroughs=("MIDDLE EAST",))
BOX = BoundingBox()
YEAR = 1998
PERIOD_SUPPORT = 2

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def money(*names: str) -> list[Column]:
    """Row-level amounts, rounded so both engines print the same digits."""
    return [rounded(F.col(name), 6).alias(name) for name in names]


# --- window and derived columns -------------------------------------------------------


@query
def window_filter(spark, sf_dir):
    return window_trips(trips(spark, sf_dir), NARROW).select(
        "l_orderkey",
        "l_linenumber",
        "pickup_ts",
        "pickup_day",
        "pickup_hour",
        *money("duration_minutes", "trip_distance", "total_amount"),
    )


@query
def calendar_parts(spark, sf_dir):
    return trips(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        "pickup_ts",
        "pickup_date",
        F.year("pickup_ts").alias("pickup_year"),
        "pickup_day",
        "pickup_hour",
    )


@query
def trip_durations(spark, sf_dir):
    return trips(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", *money("duration_minutes", "trip_distance_km")
    )


@query
def parse_timestamps(spark, sf_dir):
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        clock.parse_wall_clock(text, schemas.SPACED_SECONDS).alias("spaced_ts"),
        clock.parse_wall_clock(text, schemas.ISO_MILLIS).alias("iso_ts"),
    )


# --- demand ---------------------------------------------------------------------------


@query
def demand_topk(spark, sf_dir):
    return demand.demand_topk(trips(spark, sf_dir), NARROW)


@query
def demand_topk_sql(spark, sf_dir):
    return variants.demand_topk(trips(spark, sf_dir), NARROW)


@query
def demand_by_hour(spark, sf_dir):
    return demand.demand_by_hour(trips(spark, sf_dir), HOURS)


@query
def time_band_summary(spark, sf_dir):
    return demand.time_band_summary(trips(spark, sf_dir), TripWindow(days=None, hours=None))


@query
def weekend_profile(spark, sf_dir):
    return demand.weekend_profile(trips(spark, sf_dir), HOURS)


# --- revenue --------------------------------------------------------------------------


@query
def surcharge_components(spark, sf_dir):
    components = revenue.surcharge_components(trips(spark, sf_dir), "l_orderkey", "l_linenumber")
    return components.select(
        "l_orderkey", "l_linenumber", *money(*schemas.SURCHARGES, "surcharge_total")
    )


@query
def revenue_by_zone_bucket(spark, sf_dir):
    return revenue.revenue_by_zone_bucket(trips(spark, sf_dir), zones(spark, sf_dir), PRICED)


def _revenue_topk(spark, sf_dir, measure, min_support, k=17):
    return revenue.revenue_topk(
        trips(spark, sf_dir), zones(spark, sf_dir), PRICED, measure, k, min_support
    )


@query
def revenue_topk(spark, sf_dir):
    return _revenue_topk(spark, sf_dir, "total_revenue", 50)


@query
def revenue_topk_per_mile(spark, sf_dir):
    return _revenue_topk(spark, sf_dir, "revenue_per_mile", 10)


@query
def revenue_topk_per_minute(spark, sf_dir):
    return _revenue_topk(spark, sf_dir, "revenue_per_minute", 10)


@query
def revenue_adaptive_support(spark, sf_dir):
    return revenue.revenue_by_zone_bucket(
        trips(spark, sf_dir), zones(spark, sf_dir), PRICED, AdaptiveSupport()
    )


@query
def revenue_adaptive_between(spark, sf_dir):
    """A share of the trips that puts the threshold between its bounds at sf0.01."""
    rule = AdaptiveSupport(share=0.004)
    return revenue.revenue_by_zone_bucket(
        trips(spark, sf_dir), zones(spark, sf_dir), PRICED, rule
    )


@query
def revenue_unsupported_extreme(spark, sf_dir):
    return _revenue_topk(spark, sf_dir, "revenue_per_mile", 0, k=1)


@query
def revenue_topk_sql(spark, sf_dir):
    return variants.revenue_topk(trips(spark, sf_dir), zones(spark, sf_dir), PRICED, 50)


@query
def zone_revenue(spark, sf_dir):
    return revenue.zone_revenue(trips(spark, sf_dir), zones(spark, sf_dir), ROUTE)


# --- payments -------------------------------------------------------------------------


@query
def payment_counts(spark, sf_dir):
    return payments.payment_counts(trips(spark, sf_dir))


@query
def payment_hourly(spark, sf_dir):
    return payments.payment_hourly(trips(spark, sf_dir), PRICED)


@query
def payment_hourly_sql(spark, sf_dir):
    return variants.payment_hourly(trips(spark, sf_dir), PRICED)


@query
def vendor_payment_share_sql(spark, sf_dir):
    return variants.vendor_payment_share(trips(spark, sf_dir), PRICED)


@query
def payment_card_vs_cash_sql(spark, sf_dir):
    return variants.payment_card_vs_cash(trips(spark, sf_dir), PRICED)


@query
def vendor_payment_share(spark, sf_dir):
    return payments.vendor_payment_share(trips(spark, sf_dir), PRICED)


@query
def payment_card_vs_cash(spark, sf_dir):
    return payments.payment_card_vs_cash(trips(spark, sf_dir), PRICED)


# --- flows ----------------------------------------------------------------------------


@query
def special_zone_trips(spark, sf_dir):
    flagged = flows.special_zone_trips(trips(spark, sf_dir), zones(spark, sf_dir), HOURS, SPECIAL)
    return flagged.select(
        "l_orderkey",
        "l_linenumber",
        "pu_borough",
        "pu_zone",
        "do_borough",
        "do_zone",
        "pu_is_airport",
        "do_is_airport",
        "is_airport_trip",
    )


@query
def flows_by_borough(spark, sf_dir):
    return flows.flows_by_borough(trips(spark, sf_dir), zones(spark, sf_dir), HOURS, SPECIAL)


@query
def flows_scalar_subquery(spark, sf_dir):
    return variants.flows_by_borough(trips(spark, sf_dir), zones(spark, sf_dir), HOURS, SPECIAL)


@query
def special_zone_routes(spark, sf_dir):
    return flows.special_zone_routes(trips(spark, sf_dir), zones(spark, sf_dir), HOURS, SPECIAL)


@query
def special_zone_comparison(spark, sf_dir):
    return flows.special_zone_comparison(trips(spark, sf_dir), zones(spark, sf_dir), HOURS, SPECIAL)


def _joined(spark, sf_dir, strategy):
    return flows.pickup_zone_trips(
        trips(spark, sf_dir), zones(spark, sf_dir), HOURS, strategy
    ).select(
        "l_orderkey",
        "l_linenumber",
        "pu_location_id",
        "pu_borough",
        "pu_zone",
        "pu_service_zone",
        *money("total_amount"),
    )


@query
def join_broadcast(spark, sf_dir):
    return _joined(spark, sf_dir, "auto")


@query
def join_sort_merge(spark, sf_dir):
    return _joined(spark, sf_dir, "merge")


# --- imbalance and periods ------------------------------------------------------------


def _imbalance(spark, sf_dir):
    return imbalance.zone_imbalance(trips(spark, sf_dir), zones(spark, sf_dir), BALANCE)


@query
def zone_imbalance(spark, sf_dir):
    return _imbalance(spark, sf_dir)


@query
def zone_imbalance_outer_join(spark, sf_dir):
    return imbalance.zone_imbalance_outer_join(
        trips(spark, sf_dir), zones(spark, sf_dir), BALANCE
    )


@query
def imbalance_top_positive(spark, sf_dir):
    return imbalance.most_net_pickups(_imbalance(spark, sf_dir))


@query
def imbalance_top_positive_sql(spark, sf_dir):
    return variants.imbalance_topk(trips(spark, sf_dir), zones(spark, sf_dir), BALANCE)


@query
def imbalance_top_negative(spark, sf_dir):
    return imbalance.most_net_dropoffs(_imbalance(spark, sf_dir))


@query
def imbalance_top_abs(spark, sf_dir):
    return imbalance.most_unbalanced(_imbalance(spark, sf_dir))


@query
def imbalance_hourly(spark, sf_dir):
    return imbalance.imbalance_hourly(trips(spark, sf_dir), BALANCE)


def _od_change(spark, sf_dir):
    return periods.od_period_change(trips(spark, sf_dir), min_support=PERIOD_SUPPORT, scale=6)


@query
def od_period_change(spark, sf_dir):
    return _od_change(spark, sf_dir)


@query
def od_period_join(spark, sf_dir):
    return periods.od_period_join(trips(spark, sf_dir), min_support=PERIOD_SUPPORT, scale=6)


@query
def od_top_increase(spark, sf_dir):
    return periods.largest_increases(_od_change(spark, sf_dir))


@query
def od_top_decrease(spark, sf_dir):
    return periods.largest_decreases(_od_change(spark, sf_dir))


# --- distance, speed and congestion ---------------------------------------------------


def _distances(spark, sf_dir, form):
    measured = congestion.with_haversine(trips(spark, sf_dir), HOURS, form)
    return measured.select("l_orderkey", "l_linenumber", "pickup_hour", *money("haversine_km"))


@query
def haversine_distance(spark, sf_dir):
    return _distances(spark, sf_dir, geo.haversine_km)


@query
def haversine_asin(spark, sf_dir):
    return _distances(spark, sf_dir, geo.haversine_asin_km)


@query
def haversine_udf(spark, sf_dir):
    return _distances(spark, sf_dir, geo.haversine_batch_km)


@query
def congestion_by_hour(spark, sf_dir):
    return congestion.congestion_by_hour(trips(spark, sf_dir), HOURS)


@query
def congestion_by_hour_udf(spark, sf_dir):
    return congestion.congestion_by_hour(
        trips(spark, sf_dir), HOURS, form=geo.haversine_batch_km
    )


@query
def route_quality_by_hour(spark, sf_dir):
    return congestion.route_quality_by_hour(trips(spark, sf_dir), ROUTE, YEAR, BOX, scale=6)


@query
def route_quality_sql(spark, sf_dir):
    return variants.route_quality_by_hour(trips(spark, sf_dir), ROUTE, YEAR, BOX, scale=6)


@query
def duration_percentiles(spark, sf_dir):
    return congestion.duration_percentiles(trips(spark, sf_dir), ROUTE)


# --- profile --------------------------------------------------------------------------


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(trips(spark, sf_dir))


@query
def hourly_distribution(spark, sf_dir):
    return profile.hourly_distribution(trips(spark, sf_dir))


@query
def daily_distribution(spark, sf_dir):
    return profile.daily_distribution(trips(spark, sf_dir))


@query
def joinability(spark, sf_dir):
    return profile.joinability(trips(spark, sf_dir), zones(spark, sf_dir))


@query
def top_zones(spark, sf_dir):
    return profile.top_zones(trips(spark, sf_dir), zones(spark, sf_dir))


@query
def distance_histogram(spark, sf_dir):
    return profile.histogram(trips(spark, sf_dir), "trip_distance", 1, 10)


@query
def amount_histogram(spark, sf_dir):
    return profile.histogram(trips(spark, sf_dir), "total_amount", 1000, 50000)


@query
def distance_bucket_counts(spark, sf_dir):
    return profile.bucket_counts(trips(spark, sf_dir), "trip_distance")


@query
def amount_bucket_counts(spark, sf_dir):
    return profile.bucket_counts(trips(spark, sf_dir), "total_amount")


def _shown(frame: DataFrame) -> DataFrame:
    doubles = [name for name, kind in frame.dtypes if kind == "double"]
    return frame.select([money(n)[0] if n in doubles else F.col(n) for n in frame.columns])


@query
def largest_trips(spark, sf_dir):
    return _shown(profile.largest(trips(spark, sf_dir), "trip_distance", profile.DISTANCE_SAMPLE))


@query
def longest_trips(spark, sf_dir):
    return _shown(
        profile.largest(trips(spark, sf_dir), "duration_minutes", profile.DURATION_SAMPLE)
    )


@query
def anomaly_samples(spark, sf_dir):
    return _shown(profile.zero_durations(trips(spark, sf_dir)))


@query
def anomaly_negative_fares(spark, sf_dir):
    return _shown(profile.negative_fares(trips(spark, sf_dir)))


# --- raw files and storage ------------------------------------------------------------

PREPARED_SHOWN = (
    "vendor_id",
    "pickup_ts",
    "dropoff_ts",
    "passenger_count",
    "payment_type",
    "pickup_date",
    "pickup_day",
    "pickup_hour",
)


@query
def ingest_csv_typed(spark, sf_dir):
    raw = readers.read_zoned_csv(spark, raw_files.zoned_csv(spark, sf_dir))
    return prepare.prepared_trips(raw, schemas.ISO_MILLIS, YEAR).select(
        *PREPARED_SHOWN,
        "pu_location_id",
        "do_location_id",
        "rate_code_id",
        *money("trip_distance_km", "duration_minutes", "airport_fee", "total_amount"),
    )


@query
def ingest_csv_gps(spark, sf_dir):
    raw = readers.read_gps_csv(spark, raw_files.gps_csv(spark, sf_dir))
    return prepare.prepared_trips(raw, schemas.SPACED_SECONDS, YEAR).select(
        *PREPARED_SHOWN,
        *money(*geo.COORDINATES, "trip_distance_km", "duration_minutes", "total_amount"),
    )


@query
def ingest_accounting(spark, sf_dir):
    raw = readers.read_zoned_csv(spark, raw_files.zoned_csv(spark, sf_dir))
    return prepare.ingest_accounting(raw, schemas.ISO_MILLIS, YEAR)


@query
def zones_typed_csv(spark, sf_dir):
    return readers.read_zones_csv(spark, raw_files.zones_csv(spark, sf_dir))


@query
def zones_text_csv(spark, sf_dir):
    return readers.read_zones_csv(spark, raw_files.zones_csv(spark, sf_dir), types="text")


@query
def zones_inferred_csv(spark, sf_dir):
    return readers.read_zones_csv(spark, raw_files.zones_csv(spark, sf_dir), types="inferred")


@query
def zones_accounting(spark, sf_dir):
    return prepare.zone_accounting(readers.read_zones_csv(spark, raw_files.zones_csv(spark, sf_dir)))


@query
def zones_overwritten(spark, sf_dir):
    """A plain table written over a larger one: only the second write is there."""
    path = raw_files.zones_table(spark, sf_dir)
    return readers.read_zones(spark, path)


@query
def demand_in_order(spark, sf_dir):
    """The place of every hour in a sorted result; a few hours, so one task numbers them."""
    ordered = profile.hourly_distribution(trips(spark, sf_dir))
    row = F.monotonically_increasing_id()  # ascends in the order the rows come in
    return ordered.withColumn("row", row).select(
        "pickup_hour", "trips", F.row_number().over(Window.orderBy("row")).cast("bigint").alias("place")
    )


@query
def payment_counts_csv(spark, sf_dir):
    raw = readers.read_zoned_csv(spark, raw_files.zoned_csv(spark, sf_dir))
    return payments.payment_counts(raw)


@query
def csv_line_demand(spark, sf_dir):
    raw = readers.read_zoned_csv(spark, raw_files.zoned_csv(spark, sf_dir))
    return demand.line_demand_topk(raw, schemas.ISO_MILLIS, YEAR, HOURS)


def _screened(spark, sf_dir):
    path = raw_files.faulty_lines(spark, sf_dir)
    lines = screen.read_lines(spark, path, schemas.TRIPS_ZONED_RAW)
    return screen.screened_trips(lines, schemas.TRIPS_ZONED_RAW, schemas.ISO_MILLIS, YEAR)


@query
def line_accounting(spark, sf_dir):
    """Raw lines by what became of them."""
    return screen.line_accounting(_screened(spark, sf_dir))


@query
def line_bad_fields(spark, sf_dir):
    return screen.bad_field_counts(_screened(spark, sf_dir))


@query
def screened_demand(spark, sf_dir):
    """Trips and amount by hour of the lines that could be read."""
    kept = _screened(spark, sf_dir).filter(F.col(prepare.STATUS) == prepare.KEPT)
    return kept.groupBy("pickup_hour").agg(
        F.count("*").alias("trips"), rounded(exact_sum(F.col("total_amount")), 2).alias("total_revenue")
    )


@query
def partitions_replaced(spark, sf_dir):
    """Rows per month of a table one year of which was replaced twice, months without rows emptied."""
    table = spark.read.parquet(raw_files.months_replaced(spark, sf_dir))
    return table.groupBy("pickup_year", "pickup_month").agg(
        F.count("*").alias("trips"), F.sum("l_orderkey").alias("orders")
    )


@query
def partitioned_roundtrip(spark, sf_dir):
    return raw_files.read_trips_by_day(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        *PREPARED_SHOWN,
        "pu_location_id",
        "do_location_id",
        *money("trip_distance", "total_amount"),
    )


def _counted(windowed: DataFrame) -> DataFrame:
    return windowed.groupBy("pickup_hour").agg(
        F.count("*").alias("trips"), rounded(exact_sum(F.col("total_amount")), 2).alias("total_revenue")
    )


@query
def pruned_scan_count(spark, sf_dir):
    return _counted(window_trips(raw_files.read_trips_by_day(spark, sf_dir), NARROW))


@query
def unpruned_scan_count(spark, sf_dir):
    return _counted(window_trips_unpruned(raw_files.read_trips_by_day(spark, sf_dir), NARROW))


@query
def calendar_scan_count(spark, sf_dir):
    """The middle days of the month by a calendar, whose rows prune the partitions at run time."""
    days = spark.read.parquet(raw_files.calendar(spark, sf_dir))
    middle = F.col("part_of_month") == "middle"
    return _counted(
        window_trips_by_calendar(raw_files.read_trips_by_day(spark, sf_dir), days, middle, NARROW)
    )


@query
def join_bucketed(spark, sf_dir):
    """The zone join of two tables stored by zone id: no side is moved."""
    name = raw_files.bucketed_trips(spark, sf_dir)
    joined = flows.pickup_zone_trips(spark.table(name), spark.table(f"{name}_zones"), HOURS, "merge", checked=True)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "pu_location_id",
        "pu_borough",
        "pu_zone",
        "pu_service_zone",
        *money("total_amount"),
    )


@query
def reach_of_windows(spark, sf_dir):
    """Distinct pickup zones of several windows, all from one table of bitmaps."""
    bitmaps = spark.read.parquet(raw_files.zone_bitmaps(spark, sf_dir))
    every = bitmaps.withColumn("reach", F.lit("all"))
    by_hour = bitmaps.withColumn("reach", F.concat(F.lit("hour "), F.col("pickup_hour").cast("string")))
    by_day = bitmaps.filter("pickup_hour BETWEEN 7 AND 10").withColumn(
        "reach", F.concat(F.lit("morning of "), F.col("pickup_day").cast("string"))
    )
    return demand.distinct_zones(every.union(by_hour).union(by_day), "reach")


@query
def distance_quantiles(spark, sf_dir):
    """Whether the sketched quantiles of the straight distance have the rank they should have."""
    shares = (0.1, 0.5, 0.9)
    measured = congestion.with_haversine(trips(spark, sf_dir), ROUTE).select("pickup_hour", "haversine_km")
    found = congestion.sketched_percentiles(
        congestion.sketches(measured, "haversine_km", "pickup_hour"), shares, "pickup_hour"
    )
    ranks = measured.join(found, "pickup_hour").groupBy("pickup_hour", "share", "trips").agg(
        F.count_if(F.col("haversine_km") < F.col("quantile")).alias("below"),
        F.count_if(F.col("haversine_km") <= F.col("quantile")).alias("up_to"),
    )
    slack = F.col("trips") * congestion.RANK_ERROR + 1
    wanted = F.col("share") * F.col("trips")
    return ranks.select(
        "pickup_hour",
        "share",
        "trips",
        ((F.col("below") <= wanted + slack) & (F.col("up_to") >= wanted - slack)).alias("within_bound"),
    )


@query
def null_profile_grouped(spark, sf_dir):
    source = trips(spark, sf_dir)
    return profile.null_profile_of(_tagged(spark, sf_dir), source.columns)


def _tagged(spark, sf_dir):
    return profile.tagged_counts(trips(spark, sf_dir), {"trip_distance": (1, 10), "total_amount": (1000, 50000)})


@query
def distance_histogram_grouped(spark, sf_dir):
    return profile.histogram_of(_tagged(spark, sf_dir), "trip_distance")


@query
def joinability_grouped(spark, sf_dir):
    return profile.joinability_of(profile.trip_counts_of(_tagged(spark, sf_dir)), zones(spark, sf_dir))


@query
def largest_trips_held(spark, sf_dir):
    return _shown(profile.sample_of(profile.extreme_samples(trips(spark, sf_dir)), "largest_distance"))


@query
def anomaly_samples_held(spark, sf_dir):
    return _shown(profile.sample_of(profile.extreme_samples(trips(spark, sf_dir)), "zero_duration"))


@query
def report_sections_json(spark, sf_dir):
    """Two report sections written as JSON and read back under one shape."""
    source = trips(spark, sf_dir)
    sections = {
        "hourly": profile.hourly_distribution(source),
        "bands": demand.time_band_summary(source, TripWindow(days=None, hours=None)),
    }
    folder = raw_files.report_folder(spark)
    writers.write_sections(sections, folder)
    hourly = spark.read.schema(sections["hourly"].schema).json(f"{folder}/hourly")
    bands = spark.read.schema(sections["bands"].schema).json(f"{folder}/bands")
    return hourly.select(
        F.lit("hourly").alias("section"), F.col("pickup_hour").cast("string").alias("label"), "trips"
    ).union(bands.select(F.lit("bands"), "time_band", "total_trips"))


