"""Hand-made fixtures, agreement between variants, invariants."""

from __future__ import annotations

import datetime as dt
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plan_text import executed
from pyspark.sql import functions as F

from tripfold.functions import geo
from tripfold.functions.numbers import MEASURE, exact_avg, exact_sum
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
from tripfold.operators.window import window_trips, window_trips_unpruned
from tripfold.params import AdaptiveSupport, SpecialZones, TripWindow
from tripfold.plans.dimensions import duplicate_zone_ids
from tripfold.plans.heaps import Order, first_rows
from tripfold.plans.rollups import merged_sum, partials
from tripfold.sources.readers import register_views
from tripfold.sql import fragments, variants

OPEN = TripWindow(days=None, hours=None)
ZONE_SCHEMA = "location_id int, borough string, zone string, service_zone string"
SCHEMA = """
    vendor_id int, pickup_ts timestamp_ntz, pickup_date date, pickup_day int, pickup_hour int,
    duration_minutes double, trip_distance double, passenger_count int, pu_location_id int,
    do_location_id int, payment_type int, fare_amount double, tip_amount double,
    total_amount double, airport_fee double
"""


def trip(pu=1, do=2, hour=8, day=13, **other):
    moment = dt.datetime(2024, 11, day, hour or 0, 5)
    row = {
        "vendor_id": 1,
        "pickup_ts": moment,
        "pickup_date": moment.date(),
        "pickup_day": day,
        "pickup_hour": hour,
        "duration_minutes": 10.0,
        "trip_distance": 2.0,
        "passenger_count": 1,
        "pu_location_id": pu,
        "do_location_id": do,
        "payment_type": 1,
        "fare_amount": 10.0,
        "tip_amount": 1.0,
        "total_amount": 12.0,
        "airport_fee": 0.0,
    }
    return tuple({**row, **other}.values())


@pytest.fixture
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def two_zones(spark):
    return spark.createDataFrame(
        [(1, "Queens", "JFK Airport", "Airports"), (2, "Manhattan", "Midtown", "Yellow")],
        ZONE_SCHEMA,
    )


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns or frame.columns).collect()), key=repr)


def same(left, right):
    return left.columns == right.columns and rows(left) == rows(right)


# --- agreement between variants -------------------------------------------------------


def test_demand_forms_agree(trips):
    assert same(demand.demand_topk(trips), variants.demand_topk(trips))


def test_revenue_forms_agree(trips, zones):
    window = TripWindow(None, (7, 8, 9, 10), revenue.REVENUE_WINDOW.positive)
    assert same(
        revenue.revenue_topk(trips, zones, window, min_support=10),
        variants.revenue_topk(trips, zones, window, min_support=10),
    )


def test_payment_forms_agree(trips):
    assert same(payments.payment_hourly(trips), variants.payment_hourly(trips))


def test_flow_forms_agree(trips, zones):
    rule = SpecialZones("nation_(7|12)$", ("MIDDLE EAST",))
    assert same(
        flows.flows_by_borough(trips, zones, OPEN, rule),
        variants.flows_by_borough(trips, zones, OPEN, rule),
    )


def test_route_quality_forms_agree(trips):
    window = TripWindow(None, None, ("duration_minutes", "trip_distance"))
    assert same(
        congestion.route_quality_by_hour(trips, window, 1998, scale=6),
        variants.route_quality_by_hour(trips, window, 1998, scale=6),
    )


def test_congestion_forms_agree(trips):
    native = congestion.congestion_by_hour(trips, OPEN)
    batch = congestion.congestion_by_hour(trips, OPEN, form=geo.haversine_batch_km)
    assert native.count() == 24 and same(native, batch)


def test_imbalance_forms_agree(trips):
    assert same(
        imbalance.zone_balance(trips, OPEN), imbalance.zone_balance_outer_join(trips, OPEN)
    )


def test_period_forms_agree(trips):
    assert same(
        periods.od_period_change(trips, min_support=1, scale=6),
        periods.od_period_join(trips, min_support=1, scale=6),
    )


def test_pruned_and_unpruned_windows_agree(trips):
    window = TripWindow()
    assert same(window_trips(trips, window), window_trips_unpruned(trips, window))


def test_join_strategies_agree(trips, zones):
    auto = flows.pickup_zone_trips(trips, zones, OPEN)
    for strategy in ("merge", "shuffle_hash"):
        assert same(auto, flows.pickup_zone_trips(trips, zones, OPEN, strategy))


# --- window ---------------------------------------------------------------------------


def test_window_edges(make):
    frame = make(
        trip(),
        trip(hour=6),
        trip(hour=11),
        trip(day=11),
        trip(day=15),
        trip(duration_minutes=0.0),
        trip(duration_minutes=-5.0),
        trip(trip_distance=None),
        trip(total_amount=0.0),
        trip(hour=10, day=14),
    )
    assert rows(window_trips(frame, TripWindow()), "pickup_hour") == [(10,), (8,)]


def test_window_wraps_past_midnight(make):
    frame = make(*(trip(hour=hour) for hour in (22, 23, 0, 1, 2)))
    window = TripWindow.starting(23, 3, days=None)
    assert rows(window_trips(frame, window), "pickup_hour") == [(0,), (1,), (23,)]


# --- demand ---------------------------------------------------------------------------


def test_demand_shares_sum_to_all(trips):
    shares = demand.demand_by_hour(trips, OPEN)
    total = shares.agg(F.sum("trips").alias("n")).first().n
    assert total == window_trips(trips, OPEN).count()


def test_demand_ties_and_distinct_zones(make):
    frame = make(
        trip(hour=9, pu=1),
        trip(hour=9, pu=None),
        trip(hour=8, pu=1),
        trip(hour=8, pu=3, passenger_count=None),
        trip(hour=7, day=12),
    )
    top = demand.demand_topk(frame, k=2).collect()
    assert [(r.pickup_hour, r.trips, r.unique_pickup_zones) for r in top] == [(8, 2, 2), (9, 2, 1)]
    assert top[0].avg_passenger_count == 1.0 and top[0].trip_share_in_window == 40.0


# --- revenue --------------------------------------------------------------------------


def test_support_counts_trips_before_the_zone_join(make, two_zones):
    """1,100 windowed trips give a threshold of 11, though only 111 have a known zone."""
    known = [trip(pu=1)] * 11 + [trip(pu=2, trip_distance=20.0)] * 10
    unknown = [trip(pu=99)] * 1079
    frame = make(*known, *unknown)
    groups = revenue.revenue_with_threshold(frame, two_zones, min_support=AdaptiveSupport())
    assert rows(groups, "trips", "support_threshold") == [(10, 11), (11, 11)]
    kept = revenue.revenue_by_zone_bucket(frame, two_zones, min_support=AdaptiveSupport())
    assert rows(kept, "pickup_zone", "trips") == [("JFK Airport", 11)]


@pytest.mark.parametrize("trips_in_window, threshold", [(5, 10), (999, 10), (2900, 29), (9000, 50)])
def test_support_bounds(spark, two_zones, make, trips_in_window, threshold):
    frame = make(trip()).crossJoin(spark.range(trips_in_window)).drop("id")
    groups = revenue.revenue_with_threshold(frame, two_zones, min_support=AdaptiveSupport())
    assert groups.first().support_threshold == threshold


def test_zones_sharing_a_name_form_one_group(make, spark):
    zones = spark.createDataFrame(
        [(1, "Queens", "Corona", "Boro"), (2, "Queens", "Corona", "Boro")], ZONE_SCHEMA
    )
    frame = make(trip(pu=1, total_amount=10.0), trip(pu=2, total_amount=20.0), trip(pu=2))
    group = revenue.revenue_by_zone_bucket(frame, zones).collect()
    assert [(r.trips, r.total_revenue, r.avg_revenue_per_trip) for r in group] == [(3, 42.0, 14.0)]
    assert rows(revenue.zone_revenue(frame, zones)) == [("Corona", 3, 42.0)]


def test_missing_tip_leaves_the_average_alone(make, two_zones):
    frame = make(trip(tip_amount=4.0), trip(tip_amount=None), trip(tip_amount=2.0))
    assert revenue.revenue_by_zone_bucket(frame, two_zones).first().avg_tip_amount == 3.0


def test_surcharges_without_their_columns(make):
    frame = make(trip(airport_fee=1.75), trip(airport_fee=None))
    totals = revenue.surcharge_components(frame).select("mta_tax", "surcharge_total")
    assert rows(totals) == [(0.0, 0.0), (0.0, 1.75)]


def test_duplicate_zone_ids_are_reported(spark, two_zones):
    assert duplicate_zone_ids(two_zones).count() == 0
    assert rows(duplicate_zone_ids(two_zones.union(two_zones.limit(1)))) == [(1, 2)]


def test_a_repeated_zone_id_fails_instead_of_multiplying_trips(make, two_zones):
    doubled = two_zones.union(two_zones.limit(1))
    frame = make(trip(1, 2), trip(2, 1))
    for result in (
        revenue.revenue_by_zone_bucket(frame, doubled),
        imbalance.label_zones(imbalance.zone_balance(frame, OPEN), doubled),
        profile.top_zones(frame, doubled),
    ):
        with pytest.raises(Exception, match="zone id listed more than once: 1"):
            result.collect()


def test_money_sums_do_not_depend_on_the_partitions(spark):
    values = spark.range(400_000).selectExpr("1 AS k", "cast(id * 7919 % 100000 AS double) / 100 AS total_amount")
    sums = set()
    for parts in (3, 16, 61):
        groups = values.repartition(parts).groupBy("k").agg(*partials(["total_amount"]))
        sums.add(groups.groupBy("k").agg(merged_sum("total_amount").alias("s")).first().s)
    exact = spark.range(400_000).selectExpr("sum(id * 7919 % 100000) AS cents").first().cents
    assert sums == {exact / 100}


def test_route_quality_does_not_depend_on_the_partitions(trips):
    """Bit for bit, computed speeds and detours included, in both forms."""
    window = TripWindow(days=None, hours=None, positive=congestion.ROUTE_WINDOW.positive)
    results = {
        tuple(map(tuple, form(trips.repartition(parts), window, 1998, scale=scale).collect()))
        for form, scale in ((congestion.route_quality_by_hour, None),)
        for parts in (3, 16, 61)
    }
    assert len(results) == 1
    rounded_to_twelve = {
        tuple(map(tuple, variants.route_quality_by_hour(trips.repartition(parts), window, 1998, scale=12).collect()))
        for parts in (3, 16, 61)
    }
    assert len(rounded_to_twelve) == 1


def test_sums_keep_no_decimal_in_the_aggregate(trips):
    window = TripWindow(days=None, hours=None)
    for frame in (
        demand.demand_rollup(trips, window),
        congestion.congestion_by_hour(trips, window),
        congestion.route_quality_by_hour(trips, window),
    ):
        for line in executed(frame).splitlines():
            if "partial_sum" in line:
                assert "decimal" not in line.lower()


def test_limbs_join_to_the_exact_sum(spark):
    """Both signs, both grains, more than 53 bits of total; against integers of any size."""
    values = [(i * 999_999_937 % 10**12 - 4 * 10**11) for i in range(20_000)]
    frame = spark.createDataFrame([(v / 1e3, v / 1e12) for v in values], "x double, y double")
    row = frame.repartition(7).select(
        exact_sum(F.col("x")).alias("x"), exact_sum(F.col("y"), MEASURE).alias("y")
    ).first()
    assert row.x == float(Fraction(sum(values), 1000))
    assert row.y == pytest.approx(float(Fraction(sum(values), 10**12)), abs=1e-12 * len(values))


@pytest.mark.parametrize("form", ["frame", "text"])
def test_values_without_an_exact_form_still_show_in_sums(spark, form):
    def total(*values):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        if form == "frame":
            return frame.select(exact_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("a")).first()
        text = f"SELECT {fragments.exact('sum(x)')} AS s, {fragments.exact('avg(x)')} AS a FROM {{frame}}"
        return spark.sql(text, frame=frame).first()

    assert tuple(total(1.5, None, 2.5)) == (4.0, 2.0)
    assert tuple(total(None)) == (None, None)
    assert tuple(total(1e23, 1.0)) == (1e23, 5e22)
    assert total(float("nan"), 1.0).s != total(float("nan"), 1.0).s


# --- payments -------------------------------------------------------------------------


def test_payment_shares_and_tips(make):
    frame = make(
        trip(),
        trip(tip_amount=0.0),
        trip(payment_type=2, tip_amount=0.0),
        trip(payment_type=3),
        trip(fare_amount=0.0),
    )
    hourly = payments.payment_hourly(frame)
    assert rows(hourly, "payment_type", "payment_share_in_hour", "tip_rate", "zero_tip_share") == [
        (1, 0.6667, 0.05, 0.5),
        (2, 0.3333, 0.0, 1.0),
    ]
    side = payments.payment_card_vs_cash(frame).first()
    assert (side.card_trips, side.cash_trips, side.card_share) == (2, 1, 0.6667)
    assert side.avg_tip_rate_card == 0.05
    assert rows(payments.payment_counts(frame)) == [(1, 3), (2, 1)]


def test_payment_view_is_registered(spark, make):
    register_views(some_trips=make(trip(), trip(payment_type=3)))
    variants.register_paid_trips("some_paid_trips", "some_trips", spark.table("some_trips"))
    assert spark.table("some_paid_trips").count() == 1


# --- flows ----------------------------------------------------------------------------


def test_special_trips_by_end_and_by_fee(make, spark):
    zones = spark.createDataFrame(
        [
            (1, "Queens", "JFK Airport", "a"),
            (2, "Manhattan", "Midtown", "b"),
            (3, "EWR", "Terminal", "c"),
            (4, None, None, "d"),
        ],
        ZONE_SCHEMA,
    )
    frame = make(
        trip(1, 2),
        trip(2, 1),
        trip(2, 2),
        trip(2, 2, airport_fee=1.75),
        trip(2, 2, airport_fee=None),
        trip(3, 2),
        trip(4, 4),
        trip(2, 99),
    )
    flagged = flows.special_zone_trips(frame, zones)
    assert rows(flagged, "pu_location_id", "do_location_id", "is_airport_trip") == [
        (1, 2, 1),
        (2, 1, 1),
        (2, 2, 0),
        (2, 2, 0),
        (2, 2, 1),
        (3, 2, 1),
        (4, 4, 0),
    ]
    comparison = flows.special_zone_comparison(frame, zones)
    assert rows(comparison, "is_airport_trip", "trips") == [(0, 3), (1, 4)]
    routes = flows.special_zone_routes(frame, zones)
    assert ("Midtown", "Midtown", 1, 1.75) in rows(routes, "pu_zone", "do_zone", "trips", "avg_airport_fee")
    borough = flows.flows_by_borough(frame, zones)
    assert sum(r.trips for r in borough.collect()) == 7
    assert same(borough, variants.flows_by_borough(frame, zones))


def test_flows_without_a_fee_column(make, two_zones):
    frame = make(trip(1, 2), trip(2, 2)).drop("airport_fee")
    result = flows.special_zone_comparison(frame, two_zones)
    assert rows(result, "is_airport_trip", "trips") == [(0, 1), (1, 1)]
    assert same(
        flows.flows_by_borough(frame, two_zones), variants.flows_by_borough(frame, two_zones)
    )


# --- imbalance ------------------------------------------------------------------------


def test_one_sided_and_unknown_zones(make):
    frame = make(trip(1, 2), trip(1, 2), trip(None, 2), trip(1, None))
    columns = ("location_id", "pickups", "dropoffs", "net_pickups", "abs_imbalance_ratio")
    expected = [(1, 3, 0, 3, 1.0), (2, 0, 3, -3, 1.0), (None, 0, 1, -1, 1.0), (None, 1, 0, 1, 1.0)]
    assert rows(imbalance.zone_balance(frame), *columns) == expected
    assert rows(imbalance.zone_balance_outer_join(frame), *columns) == expected


def test_net_pickups_cancel_within_an_hour(trips):
    sums = imbalance.zone_balance(trips, OPEN).groupBy("pickup_hour").agg(F.sum("net_pickups"))
    assert {row[1] for row in sums.collect()} == {0}


def test_imbalance_threshold_and_names(make, two_zones):
    frame = make(*[trip(1, 9)] * 3, trip(2, 2))
    kept = imbalance.zone_imbalance(frame, two_zones, min_activity=3)
    assert rows(kept, "location_id", "zone", "activity") == [(1, "JFK Airport", 3), (9, None, 3)]
    hourly = imbalance.imbalance_hourly(frame).first()
    assert (hourly.total_abs_net_pickups, hourly.avg_abs_imbalance_ratio) == (6, 0.6667)


def test_imbalance_rankings_take_the_right_end(make, two_zones):
    table = imbalance.zone_imbalance(make(*[trip(1, 2)] * 3, trip(2, 2)), two_zones, min_activity=1)
    assert imbalance.most_net_pickups(table, 1).first().location_id == 1
    assert imbalance.most_net_dropoffs(table, 1).first().location_id == 2
    assert imbalance.most_unbalanced(table, 1).first().location_id == 1


# --- periods --------------------------------------------------------------------------


def test_period_split_and_support(make):
    frame = make(
        trip(day=15, fare_amount=10.0),
        trip(day=16, fare_amount=15.0),
        trip(day=17, fare_amount=15.0),
        trip(pu=5, day=1),
        trip(pu=None, day=1),
        trip(pu=None, day=20),
    )
    change = periods.od_period_change(frame, min_support=0).collect()
    assert [(r.trips_h1, r.trips_h2, r.trips_change_pct, r.fare_change_pct) for r in change] == [
        (1, 2, 100.0, 50.0)
    ]
    assert periods.od_period_change(frame, min_support=2).count() == 0


# --- profile --------------------------------------------------------------------------


def test_null_profile(make):
    frame = make(trip(passenger_count=None), trip(), trip())
    profiled = profile.null_profile(frame)
    assert profiled.first().asDict() == {"column_name": "passenger_count", "null_pct": 33.33}
    assert profiled.count() == len(frame.columns)
    assert profile.null_profile(frame.limit(0)).count() == 0


def test_joinability_counts_each_end_once(make, two_zones):
    frame = make(trip(1, 2), trip(1, 9), trip(None, 9))
    doubled = two_zones.union(two_zones)
    expected = [("dropoff", 3, 2, 33.3333), ("pickup", 3, 1, 66.6667)]
    assert rows(profile.joinability(frame, doubled)) == expected


def test_top_zones_keep_unknown_ids(make, two_zones):
    frame = make(trip(8), trip(9), trip(1))
    assert rows(profile.top_zones(frame, two_zones)) == [("JFK Airport", 1), (None, 2)]


def test_histogram_loses_no_row(make):
    frame = make(*(trip(total_amount=v) for v in (-7.5, 0.0, 0.9, 5.0, 900.0, None)))
    counted = profile.histogram(frame, "total_amount", 0, 10)
    assert rows(counted) == [(-1, 1), (0, 2), (10, 1), (5, 1), (None, 1)]
    assert rows(profile.bucket_counts(frame, "total_amount")) == [(-8, 1), (0, 2), (5, 1), (900, 1)]
    both = profile.tagged_counts(frame, {"total_amount": (0, 10), "trip_distance": (0, 3)})
    assert rows(profile.null_profile_of(both, frame.columns)) == rows(profile.null_profile(frame))
    assert rows(profile.histogram_of(both, "total_amount")) == rows(counted)
    assert rows(profile.histogram_of(both, "trip_distance")) == rows(
        profile.histogram(frame, "trip_distance", 0, 3)
    )


def test_samples_of_one_scan_are_those_taken_one_by_one(trips):
    samples = profile.extreme_samples(trips)
    for name, (_, lead, columns) in profile.SAMPLES.items():
        alone = {
            "negative_fare": profile.negative_fares,
            "zero_duration": profile.zero_durations,
        }.get(name, lambda t: profile.largest(t, lead, columns))(trips)
        assert profile.sample_of(samples, name).collect() == alone.collect()


NUMBERS = st.one_of(st.none(), st.sampled_from([float("nan"), float("inf"), float("-inf"), -0.5, 0.0, 1.0, 2.0]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), NUMBERS, st.integers(0, 2)), max_size=40), st.integers(1, 6))
def test_held_rows_are_those_of_a_sort(spark, rows, k):
    """Nulls, NaN, infinities and ties, in both directions, over several tasks and batches."""
    frame = spark.createDataFrame(rows, "a int, b double, c int").repartition(3)
    orders = {
        "up": Order(F.lit(True), (("a", False), ("b", False), ("c", False))),
        "down": Order(F.col("c") > 0, (("b", True), ("a", True), ("c", False))),
    }
    found = first_rows(frame, orders, k, "a", "b", "c").orderBy("sample", "place").collect()
    for name, order in orders.items():
        sorted_by = [F.desc(n) if down else F.asc(n) for n, down in order.keys]
        expected = frame.filter(order.condition).orderBy(*sorted_by).limit(k).collect()
        own = [r for r in found if r["sample"] == name]
        assert [r.place for r in own] == list(range(1, len(expected) + 1))
        assert list(map(repr, [(r.a, r.b, r.c) for r in own])) == list(map(repr, [tuple(r) for r in expected]))


def test_null_columns_beyond_one_mask_are_counted(spark):
    names = [f"c{i}" for i in range(130)]
    values = [F.when(F.col("id") % (i + 2) == 0, F.lit(1)).alias(name) for i, name in enumerate(names)]
    keys = [F.lit(1).alias(name) for name in profile.ZONE_KEYS]
    frame = spark.range(40).select(*keys, *values)
    counts = profile.tagged_counts(frame, {"c0": (0, 3)})
    assert rows(profile.null_profile_of(counts, frame.columns)) == rows(profile.null_profile(frame))


def test_samples_repeat(make):
    frame = make(
        trip(fare_amount=-1.0),
        trip(duration_minutes=0.0, total_amount=3.0),
        trip(duration_minutes=0.0, total_amount=2.0),
        trip(trip_distance=99.0),
    )
    assert profile.negative_fares(frame).count() == 1
    assert [r.total_amount for r in profile.zero_durations(frame, 1).collect()] == [2.0]
    assert profile.largest(frame, "trip_distance", profile.DISTANCE_SAMPLE, 1).first()[2] == 99.0


# --- property tests against plain Python ----------------------------------------------

ends = st.tuples(
    st.one_of(st.none(), st.integers(1, 4)), st.one_of(st.none(), st.integers(1, 4)), st.integers(0, 2)
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ends, min_size=1, max_size=30))
def test_balance_against_counting(make, sample):
    frame = make(*(trip(pu, do, hour) for pu, do, hour in sample))
    expected = {}
    for pu, do, hour in sample:
        for zone, side in ((pu, 0), (do, 1)):
            key = (hour, zone, side if zone is None else None)
            expected.setdefault(key, [0, 0])[side] += 1
    counted = sorted(((h, z, p, d) for (h, z, _), (p, d) in expected.items()), key=repr)
    for form in (imbalance.zone_balance, imbalance.zone_balance_outer_join):
        result = form(frame, OPEN)
        assert rows(result, "pickup_hour", "location_id", "pickups", "dropoffs") == counted


# --- mergeable state ------------------------------------------------------------------


def test_bitmaps_count_distinct_zones(spark, trips):
    for zone in ("pu_location_id", "pu_location_id * 100003", "pu_location_id * 32768"):
        frame = trips.withColumn("pu_location_id", F.expr(f"cast({zone} AS int)"))
        bitmaps = demand.zone_bitmaps(frame, "pickup_day", "pickup_hour")
        for keys in (("pickup_day",), ("pickup_hour",), ()):
            exact = frame.filter("pu_location_id IS NOT NULL").groupBy(*keys).agg(
                F.countDistinct("pu_location_id").alias("unique_pickup_zones")
            )
            assert rows(demand.distinct_zones(bitmaps, *keys)) == rows(exact)


@pytest.mark.parametrize("shape", ["id", "id % 7", "exp(id / 20000.0)", "-1.0 * id * id"])
def test_sketched_ranks_stay_within_the_bound(spark, shape):
    """Merged over many parts of uneven size, against exact ranks."""
    values = spark.range(0, 200_000, 1, 5).selectExpr(f"cast({shape} AS double) AS v", "cast(sqrt(id) / 9 AS int) AS k")
    state = congestion.sketches(values, "v", "k")
    shares = (0.01, 0.25, 0.5, 0.9, 0.999)
    for row in congestion.sketched_percentiles(state, shares).collect():
        below, up_to = values.select(
            F.count_if(F.col("v") < row.quantile), F.count_if(F.col("v") <= row.quantile)
        ).first()
        slack = congestion.RANK_ERROR * row.trips
        assert row.trips == 200_000
        assert below - slack <= row.share * row.trips <= up_to + slack


def test_sketches_leave_out_nulls_and_nan(spark):
    frame = spark.createDataFrame([(None,), (float("nan"),), (2.0,), (2.0,)], "v double")
    (row,) = congestion.sketched_percentiles(congestion.sketches(frame, "v"), (0.5,)).collect()
    assert (row.trips, row.quantile) == (2, 2.0)
