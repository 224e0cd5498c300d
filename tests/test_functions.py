from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripfold import schemas
from tripfold.functions import clock, geo, money
from tripfold.sql import fragments
from tripfold.functions.numbers import banded, optional_amount, percent_change, ratio, rounded
from tripfold.params import BoundingBox, TripWindow, wrapped_hours


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = frame.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def test_time_band_edges(spark):
    hours = [0, 5, 6, 11, 12, 16, 17, 21, 22, 23, None]
    assert column(spark, hours, "int", clock.time_band) == [
        "Night",
        "Night",
        "Morning",
        "Morning",
        "Afternoon",
        "Afternoon",
        "Evening",
        "Evening",
        "Late",
        "Late",
        "Late",
    ]


def test_distance_bucket_edges(spark):
    miles = [0.99, 1.0, 2.99, 3.0, 9.99, 10.0, None]
    assert column(spark, miles, "double", money.distance_bucket) == [
        "very_short",
        "short",
        "short",
        "medium",
        "medium",
        "long",
        None,
    ]


def test_weekend(spark):
    days = [dt.date(2024, 11, 15) + dt.timedelta(days=i) for i in range(4)]  # Friday first
    assert column(spark, days, "date", clock.is_weekend) == [False, True, True, False]


def test_timestamps_of_either_layout(spark):
    texts = [
        "2024-11-13 08:15:30",
        "2024-11-13T08:15:30.250",
        "2024-11-13",
        "2024-02-30 00:00:00",
        "bad",
        None,
    ]
    moment = dt.datetime(2024, 11, 13, 8, 15, 30)
    spaced = column(spark, texts, "string", lambda c: clock.parse_wall_clock(c, schemas.SPACED_SECONDS))
    iso = column(spark, texts, "string", lambda c: clock.parse_wall_clock(c, schemas.ISO_MILLIS))
    assert spaced == [moment, None, None, None, None, None]
    assert iso == [None, moment.replace(microsecond=250000), None, None, None, None]


def test_time_does_not_depend_on_the_session_zone(spark, setting):
    text = ["2024-03-10 02:30:00"]  # a local time New York skips

    def hour(c):
        return F.hour(clock.parse_wall_clock(c, schemas.SPACED_SECONDS))

    def minutes(c):
        start = clock.parse_wall_clock(c, schemas.SPACED_SECONDS)
        return clock.minutes_between(start, start + F.expr("INTERVAL '3' HOUR"))

    setting(spark__sql__session__timeZone="America/New_York")
    assert column(spark, text, "string", hour) == [2]
    assert column(spark, text, "string", minutes) == [180.0]


@pytest.mark.parametrize("form", ["frame", "text"])
def test_rounding_happens_once(spark, form):
    values = [2.0049999996, 2.005, 113.275, -2.675, 2.5, float("nan"), 1e23, float("inf"), None]
    round_up = (lambda c: rounded(c, 2)) if form == "frame" else (lambda c: F.expr(fragments.rounded("v", 2)))
    result = [
        row.r
        for row in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
        .select("i", round_up(F.col("v")).alias("r"))
        .orderBy("i")
        .collect()
    ]
    assert result[:5] == [2.0, 2.01, 113.28, -2.68, 2.5]
    assert math.isnan(result[5]) and result[6:] == [1e23, float("inf"), None]


def test_ratio_and_change_survive_zero(spark):
    frame = spark.createDataFrame([(2, 3), (0, 3)], "a int, b int")
    rows = frame.select(
        ratio(F.col("b"), F.col("a")).alias("r"),
        percent_change(F.col("a"), F.col("b")).alias("c"),
    ).collect()
    assert [tuple(row) for row in rows] == [(1.5, 50.0), (None, None)]


def test_banded_takes_first_bound_above(spark):
    assert column(spark, [-1, 0, 1, 2], "int", lambda c: banded(c, ((0, "a"), (2, "b")), "c")) == [
        "a",
        "b",
        "b",
        "c",
    ]


@pytest.mark.parametrize("name", ["airport_fee", "Airport_fee", "AIRPORT_FEE"])
def test_optional_amount_ignores_case(spark, name):
    frame = spark.createDataFrame([(1.25,), (None,)], f"{name} double")
    rows = frame.select(optional_amount(frame, "airport_fee").alias("r")).collect()
    assert sorted(row.r for row in rows) == [0.0, 1.25]


def test_optional_amount_of_a_missing_column(spark):
    frame = spark.createDataFrame([(1,)], "other int")
    assert frame.select(optional_amount(frame, "airport_fee").alias("r")).first().r == 0.0


POINTS = [
    (40.0, -74.0, 40.0, -74.0),
    (40.0, -74.0, 41.0, -74.0),
    (0.0, 0.0, 0.0, 180.0),
    (None, -74.0, 41.0, -74.0),
    (40.0, -74.0, 41.0, None),
    (40.0, -74.0, 140.0, -74.0),
    (12.3456789, 45.6789, -12.3456789, -134.3211),
]
DEGREE = math.pi * 6371.0 / 180


@pytest.mark.parametrize("form", [geo.haversine_km, geo.haversine_asin_km, geo.haversine_batch_km])
def test_haversine_known_pairs(spark, form):
    frame = spark.createDataFrame(POINTS, "a double, b double, c double, d double").coalesce(1)
    distance = form(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    distances = [row.r for row in frame.select(distance.alias("r")).collect()]
    assert distances[0] == 0.0
    assert distances[1] == pytest.approx(DEGREE)
    assert distances[2] == pytest.approx(180 * DEGREE)
    assert all(value is None or math.isnan(value) for value in distances[3:5])
    assert distances[5] == pytest.approx(100 * DEGREE)  # beyond the pole, still a number
    assert distances[6] == pytest.approx(180 * DEGREE, abs=0.01)


def test_coordinates_filters(spark):
    names = ", ".join(f"{name} double" for name in geo.COORDINATES)
    rows = [
        (40.7, -74.0, 40.8, -73.9),
        (0.0, -74.0, 40.8, -73.9),
        (None, -74.0, 40.8, -73.9),
        (41.5, -74.5, 40.0, -73.0),
        (41.6, -74.0, 40.8, -73.9),
    ]
    frame = spark.createDataFrame(rows, names)
    assert frame.filter(geo.has_coordinates()).count() == 3
    assert frame.filter(geo.within(BoundingBox())).count() == 2


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(*[st.sampled_from([-90.0, -73.9, 0.0, 1e-9, 40.7, 40.7 + 1e-9, 90.0, 137.0])] * 4),
        min_size=1,
        max_size=200,
    )
)
def test_moved_is_distance_above_zero(spark, points):
    names = ", ".join(f"{name} double" for name in geo.COORDINATES)
    frame = spark.createDataFrame(points, names)
    distances = (geo.straight_line_km(), geo.haversine_asin_km(*map(F.col, geo.COORDINATES)))
    differing = " OR ".join(f"moved <> (d{i} > 0)" for i in range(2))
    tested = frame.select(
        geo.moved().alias("moved"), *(d.alias(f"d{i}") for i, d in enumerate(distances))
    )
    assert tested.filter(differing).count() == 0


def test_slow_flag_and_detour(spark):
    frame = spark.createDataFrame([(9.0, 0.5), (9.0, 1.0), (10.0, 1.0)], "s double, d double")
    flags = frame.select(geo.slow_flag(F.col("s"), 10, F.col("d"), 1).alias("r")).collect()
    assert [row.r for row in flags] == [0, 1, 0]
    detours = frame.select(geo.detour_ratio(F.col("s"), F.col("d"), 0.5).alias("r")).collect()
    assert [row.r for row in detours] == [None, 9.0, 10.0]


def test_tip_measures(spark):
    frame = spark.createDataFrame(
        [(1, 2.0, 10.0), (2, 0.0, 10.0), (1, 1.0, 0.0)],
        "payment_type int, tip_amount double, fare_amount double",
    )
    rows = frame.select(
        money.tip_rate().alias("any"),
        money.tip_rate(card_only=True).alias("card"),
        money.zero_tip_flag().alias("zero"),
    ).collect()
    assert [tuple(row) for row in rows] == [(0.2, 0.2, 0.0), (0.0, None, 1.0), (None, None, 0.0)]


def test_hours_wrap_past_midnight():
    assert wrapped_hours(22, 4) == (22, 23, 0, 1)
    assert TripWindow.starting(7, 4).hours == (7, 8, 9, 10)
    with pytest.raises(ValueError):
        wrapped_hours(0, 25)
    with pytest.raises(ValueError):
        TripWindow(hours=(24,))
    with pytest.raises(ValueError):
        TripWindow(days=(0,))
