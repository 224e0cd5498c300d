"""The questions as SQL text over frames passed by name.

``spark.sql`` binds ``{trips}`` and ``{zones}`` to the given frames, so no view leaks into
the session. Denominators are scalar subqueries here, where the DataFrame forms use a window
over the grouped rows: the text reads the facts twice and serves as an independent check.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from tripfold.functions.geo import EARTH_RADIUS_KM, KM_PER_MILE
from tripfold.functions.money import CARD, CASH
from tripfold.functions.numbers import MEASURE
from tripfold.operators.congestion import ROUTE_WINDOW
from tripfold.operators.imbalance import BALANCE_WINDOW
from tripfold.operators.payments import PAYMENT_WINDOW
from tripfold.operators.revenue import REVENUE_WINDOW
from tripfold.params import (
    DEFAULT_ACTIVITY,
    DEFAULT_K,
    DEFAULT_SUPPORT,
    BoundingBox,
    SpecialZones,
    TripWindow,
)
from tripfold.sql.fragments import (
    distance_bucket,
    double,
    exact_sum,
    measured,
    merged_sum,
    partials,
    predicate,
    rounded,
    special,
    surcharge_total,
    time_band,
)


def demand_topk(
    trips: DataFrame, window: TripWindow = TripWindow(), k: int = DEFAULT_K
) -> DataFrame:
    share = "trips / (SELECT count(*) FROM windowed) * 100"
    return trips.sparkSession.sql(
        f"""
        WITH windowed AS (
            SELECT * FROM {{trips}} WHERE {predicate(window)}
        ), hourly AS (
            SELECT
                pickup_date,
                pickup_hour,
                count(*) AS trips,
                count(DISTINCT pu_location_id) AS unique_pickup_zones,
                {measured("avg(passenger_count)", 2)} AS avg_passenger_count,
                {measured("avg(duration_minutes)", 2)} AS avg_duration_minutes,
                {measured("avg(trip_distance)", 2)} AS avg_trip_distance,
                {measured("avg(total_amount)", 2)} AS avg_total_amount,
                {measured("sum(total_amount)", 2)} AS total_revenue
            FROM windowed
            GROUP BY pickup_date, pickup_hour
        )
        SELECT
            pickup_date,
            pickup_hour,
            {time_band("pickup_hour")} AS time_band,
            * EXCEPT (pickup_date, pickup_hour),
            {rounded(share, 2)} AS trip_share_in_window
        FROM hourly
        ORDER BY trips DESC, total_revenue DESC, pickup_date, pickup_hour
        LIMIT {int(k)}
        """,
        trips=trips,
    )


def revenue_topk(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = REVENUE_WINDOW,
    min_support: int = DEFAULT_SUPPORT,
    k: int = DEFAULT_K,
) -> DataFrame:
    surcharges = f"({surcharge_total(trips.columns)})"
    return trips.sparkSession.sql(
        f"""
        SELECT
            borough AS pickup_borough,
            zone AS pickup_zone,
            {distance_bucket("trip_distance")} AS distance_bucket,
            count(*) AS trips,
            {measured("sum(total_amount)", 2)} AS total_revenue,
            {measured("avg(total_amount)", 2)} AS avg_revenue_per_trip,
            {measured("try_divide(sum(total_amount), sum(trip_distance))", 2)} AS revenue_per_mile,
            {measured("try_divide(sum(total_amount), sum(duration_minutes))", 2)}
                AS revenue_per_minute,
            {measured("avg(fare_amount)", 2)} AS avg_fare_amount,
            {measured("avg(tip_amount)", 2)} AS avg_tip_amount,
            {measured(f"try_divide({exact_sum(surcharges)}, sum(total_amount))", 4)}
                AS surcharge_share
        FROM {{trips}} JOIN {{zones}} ON pu_location_id = location_id
        WHERE {predicate(window)}
        GROUP BY ALL
        HAVING count(*) >= {int(min_support)}
        ORDER BY total_revenue DESC, pickup_borough, pickup_zone, distance_bucket
        LIMIT {int(k)}
        """,
        trips=trips,
        zones=zones,
    )


def register_paid_trips(
    view: str, trips_view: str, trips: DataFrame, window: TripWindow = PAYMENT_WINDOW
) -> None:
    """Create a temp view, in SQL, of card and cash trips with their tip measures."""
    trips.sparkSession.sql(
        f"""
        CREATE OR REPLACE TEMP VIEW {view} AS
        SELECT
            *,
            try_divide(tip_amount, fare_amount) AS tip_rate,
            if(tip_amount = 0, 1e0, 0e0) AS zero_tip
        FROM {trips_view}
        WHERE {predicate(window)} AND payment_type IN (1, 2)
        """
    )


def payment_hourly(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    """Payment mix per hour, through registered views."""
    share = "trips / sum(trips) OVER (PARTITION BY pickup_hour)"
    return _over_paid_trips(
        trips,
        window,
        lambda paid: f"""
        SELECT
            pickup_hour,
            payment_type,
            trips,
            {rounded(share, 4)} AS payment_share_in_hour,
            * EXCEPT (pickup_hour, payment_type, trips)
        FROM (
            SELECT
                pickup_hour,
                payment_type,
                count(*) AS trips,
                {measured("avg(fare_amount)", 2)} AS avg_fare_amount,
                {measured("avg(total_amount)", 2)} AS avg_total_amount,
                {measured("avg(tip_amount)", 2)} AS avg_tip_amount,
                {measured("avg(tip_rate)", 4)} AS tip_rate,
                {measured("avg(zero_tip)", 4)} AS zero_tip_share,
                {measured("avg(trip_distance)", 2)} AS avg_trip_distance,
                {measured("avg(duration_minutes)", 2)} AS avg_duration_minutes
            FROM {paid}
            GROUP BY pickup_hour, payment_type
        )
        ORDER BY pickup_hour, payment_type
        """,
    )


def vendor_payment_share(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    share = "trips / sum(trips) OVER (PARTITION BY vendor_id)"
    return _over_paid_trips(
        trips,
        window,
        lambda paid: f"""
        SELECT vendor_id, payment_type, trips, {rounded(share, 4)} AS payment_share
        FROM (SELECT vendor_id, payment_type, count(*) AS trips FROM {paid} GROUP BY ALL)
        ORDER BY vendor_id, payment_type
        """,
    )


def payment_card_vs_cash(trips: DataFrame, window: TripWindow = PAYMENT_WINDOW) -> DataFrame:
    """Card and cash side by side per hour, from measures split into two columns each."""
    split = ", ".join(
        f"if(payment_type = {code}, {name}, NULL) AS {name}_{kind}"
        for name in ("total_amount", "fare_amount", "tip_rate")
        for code, kind in ((CARD, "card"), (CASH, "cash"))
    )
    return _over_paid_trips(
        trips,
        window,
        lambda paid: f"""
        SELECT
            pickup_hour,
            count_if(payment_type = {CARD}) AS card_trips,
            count_if(payment_type = {CASH}) AS cash_trips,
            {rounded(f"count_if(payment_type = {CARD}) / count(*)", 4)} AS card_share,
            {measured("avg(total_amount_card)", 2)} AS avg_total_card,
            {measured("avg(total_amount_cash)", 2)} AS avg_total_cash,
            {measured("avg(fare_amount_card)", 2)} AS avg_fare_card,
            {measured("avg(fare_amount_cash)", 2)} AS avg_fare_cash,
            {measured("avg(tip_rate_card)", 4)} AS avg_tip_rate_card
        FROM (SELECT pickup_hour, payment_type, {split} FROM {paid})
        GROUP BY pickup_hour
        ORDER BY pickup_hour
        """,
    )


def _over_paid_trips(trips: DataFrame, window: TripWindow, text: Callable[[str], str]) -> DataFrame:
    """A query over a view derived in SQL from a view of the trips.

    The names are new ones each time, and the views go once the query is analysed.
    """
    spark, suffix = trips.sparkSession, uuid.uuid4().hex
    base, paid = f"trips_{suffix}", f"paid_trips_{suffix}"
    trips.createOrReplaceTempView(base)
    try:
        register_paid_trips(paid, base, trips, window)
        return spark.sql(text(paid))
    finally:
        spark.catalog.dropTempView(paid)
        spark.catalog.dropTempView(base)


def flows_by_borough(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    rule: SpecialZones = SpecialZones(),
    k: int = DEFAULT_K,
) -> DataFrame:
    columns = {name.lower() for name in trips.columns}
    fee_paid = "coalesce(airport_fee, 0e0) > 0" if "airport_fee" in columns else "false"
    touched = f"{special('o', rule)} OR {special('d', rule)} OR {fee_paid}"
    share = "count(*) / (SELECT count(*) FROM flagged) * 100"
    return trips.sparkSession.sql(
        f"""
        WITH flagged AS (
            SELECT
                o.borough AS pu_borough,
                d.borough AS do_borough,
                total_amount,
                trip_distance,
                duration_minutes,
                if({touched}, 1, 0) AS is_airport_trip
            FROM {{trips}}
            JOIN {{zones}} AS o ON pu_location_id = o.location_id
            JOIN {{zones}} AS d ON do_location_id = d.location_id
            WHERE {predicate(window)}
        )
        SELECT
            pu_borough,
            do_borough,
            count(*) AS trips,
            {rounded(share, 2)} AS trip_share_percent,
            {measured("sum(total_amount)", 2)} AS total_revenue,
            {measured("avg(total_amount)", 2)} AS avg_total_amount,
            {measured("avg(trip_distance)", 2)} AS avg_trip_distance,
            {measured("avg(duration_minutes)", 2)} AS avg_duration_minutes,
            {measured("avg(is_airport_trip) * 100", 2)} AS airport_trip_share_percent
        FROM flagged
        GROUP BY pu_borough, do_borough
        ORDER BY trips DESC, pu_borough, do_borough
        LIMIT {int(k)}
        """,
        trips=trips,
        zones=zones,
    )


def imbalance_topk(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = BALANCE_WINDOW,
    min_activity: int = DEFAULT_ACTIVITY,
    k: int = DEFAULT_K,
) -> DataFrame:
    return trips.sparkSession.sql(
        f"""
        WITH ends AS (
            SELECT pickup_hour, stack(2, true, pu_location_id, false, do_location_id)
                AS (leaves, location_id)
            FROM {{trips}}
            WHERE {predicate(window)}
        ), balance AS (
            SELECT
                pickup_hour,
                location_id,
                count_if(leaves) AS pickups,
                count_if(NOT leaves) AS dropoffs,
                pickups + dropoffs AS activity,
                pickups - dropoffs AS net_pickups,
                net_pickups / activity AS imbalance_ratio
            FROM ends
            GROUP BY pickup_hour, location_id, if(location_id IS NULL, leaves, NULL)
        )
        SELECT
            balance.*,
            abs(imbalance_ratio) AS abs_imbalance_ratio,
            borough,
            zone,
            service_zone
        FROM balance LEFT JOIN {{zones}} USING (location_id)
        WHERE activity >= {int(min_activity)}
        ORDER BY net_pickups DESC, pickup_hour, location_id
        LIMIT {int(k)}
        """,
        trips=trips,
        zones=zones,
    )


def route_quality_by_hour(
    trips: DataFrame,
    window: TripWindow = ROUTE_WINDOW,
    year: int | None = None,
    box: BoundingBox = BoundingBox(),
    slow_below_kmh: float = 10.0,
    slow_from_km: float = 1.0,
    scale: int = 6,
) -> DataFrame:
    """Averages and exact percentiles from one table of counts and sums per hour and duration."""

    def inside(limits: tuple[float, float]) -> str:
        return f"BETWEEN {double(limits[0])} AND {double(limits[1])}"

    def shown(value: str, name: str) -> str:
        return f"{rounded(value, scale)} AS {name}"

    def total(name: str) -> str:
        return merged_sum(name, MEASURE)

    def cut(share: float) -> str:
        return f"min(CASE WHEN running >= {double(share)} * n_in_hour THEN duration_minutes END)"

    slow = f"if(speed_kmh < {double(slow_below_kmh)} AND metered_km >= {double(slow_from_km)}, 1, 0)"
    in_year = "true" if year is None else (
        f"pickup_ts >= TIMESTAMP_NTZ'{int(year):04d}-01-01 00:00:00'"
        f" AND pickup_ts < TIMESTAMP_NTZ'{int(year) + 1:04d}-01-01 00:00:00'"
    )
    return trips.sparkSession.sql(
        f"""
        WITH measured AS (
            SELECT
                pickup_hour,
                duration_minutes,
                duration_minutes AS duration,
                trip_distance * {double(KM_PER_MILE)} AS metered_km,
                metered_km / (duration_minutes / 60e0) AS speed_kmh,
                pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2) AS north,
                pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2) AS east,
                north + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude)) * east
                    AS chord,
                {double(2 * EARTH_RADIUS_KM)} * asin(sqrt(least(chord, 1e0))) AS straight_km,
                if(straight_km > 0.2e0, metered_km / straight_km, NULL) AS detour
            FROM {{trips}}
            WHERE {predicate(window)}
                AND {in_year}
                AND pickup_ts IS NOT NULL
                AND dropoff_ts IS NOT NULL
                AND pickup_latitude {inside(box.latitude)}
                AND dropoff_latitude {inside(box.latitude)}
                AND pickup_longitude {inside(box.longitude)}
                AND dropoff_longitude {inside(box.longitude)}
        ), counted AS (
            SELECT
                pickup_hour,
                duration_minutes,
                count(*) AS n,
                {partials(("duration", "speed_kmh", "metered_km", "straight_km", "detour"), MEASURE)},
                count(detour) AS n_detours,
                sum({slow}) AS slow
            FROM measured
            GROUP BY pickup_hour, duration_minutes
        ), ranked AS (
            SELECT
                *,
                sum(n) OVER (PARTITION BY pickup_hour ORDER BY duration_minutes) AS running,
                sum(n) OVER (PARTITION BY pickup_hour) AS n_in_hour
            FROM counted
        )
        SELECT
            pickup_hour,
            sum(n) AS trips,
            {shown(f"{total('duration')} / sum(n)", "avg_duration_minutes")},
            {shown(cut(0.5), "median_duration_minutes")},
            {shown(cut(0.9), "p90_duration_minutes")},
            {shown(f"{total('speed_kmh')} / sum(n)", "avg_speed_kmh")},
            {shown(f"{total('metered_km')} / ({total('duration')} / 60e0)", "agg_speed_kmh")},
            {shown(f"{total('straight_km')} / sum(n)", "avg_haversine_km")},
            {shown(f"({total('metered_km')} - {total('straight_km')}) / sum(n)", "avg_distance_gap_km")},
            {shown(f"try_divide({total('detour')}, sum(n_detours))", "avg_detour_ratio")},
            {shown("sum(slow) / sum(n)", "congestion_candidate_share")}
        FROM ranked
        GROUP BY pickup_hour
        ORDER BY pickup_hour
        """,
        trips=trips,
    )
