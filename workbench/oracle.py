"""DuckDB text for every registered query, written against the given tables only."""

from __future__ import annotations

import re

TRIPS = """
base AS (
    SELECT
        *,
        o_orderdate + to_seconds(CAST((l_orderkey * 7919 + l_linenumber * 613) % 86400 AS BIGINT))
            AS start_ts,
        date_diff('day', o_orderdate, l_shipdate) AS dd
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
),
trips AS (
    SELECT
        l_orderkey,
        l_linenumber,
        CAST(l_suppkey % 2 + 1 AS INTEGER) AS vendor_id,
        start_ts AS pickup_ts,
        start_ts + to_seconds(CAST(dd * 6 AS BIGINT)) AS dropoff_ts,
        CAST(start_ts AS DATE) AS pickup_date,
        CAST(day(start_ts) AS INTEGER) AS pickup_day,
        CAST(hour(start_ts) AS INTEGER) AS pickup_hour,
        (dd * 6) / 60e0 AS duration_minutes,
        CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS passenger_count,
        l_quantity / 4e0 AS trip_distance,
        l_quantity / 4e0 * 1.60934e0 AS trip_distance_km,
        CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 37 = 0 THEN c_nationkey + 100
             ELSE c_nationkey END AS pu_location_id,
        CASE WHEN l_orderkey % 41 <> 0 THEN s_nationkey + 5 END AS do_location_id,
        CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS INTEGER)
            AS payment_type,
        CASE WHEN l_orderkey % 89 = 0 THEN -l_extendedprice ELSE l_extendedprice END
            AS fare_amount,
        CASE WHEN l_returnflag = 'A' THEN l_extendedprice * l_discount ELSE 0e0 END AS tip_amount,
        l_extendedprice * l_tax AS extra,
        CASE WHEN l_linenumber <> 5 THEN 0.5e0 END AS mta_tax,
        CASE WHEN l_linenumber % 3 = 0 THEN 6.55e0 ELSE 0e0 END AS tolls_amount,
        CASE WHEN l_suppkey % 5 <> 0 THEN 0.3e0 END AS improvement_surcharge,
        CASE WHEN l_suppkey % 4 <> 0 THEN 2.5e0 END AS congestion_surcharge,
        CASE WHEN l_linestatus = 'F' THEN NULL WHEN l_linenumber = 6 THEN 1.75e0 ELSE 0e0 END
            AS airport_fee,
        l_extendedprice * (1 + l_tax) AS total_amount,
        CASE WHEN l_orderkey % 50 = 0 THEN 0e0
             ELSE 40.6e0 + (c_nationkey % 5) * 0.05e0 + l_linenumber * 0.001e0 END
            AS pickup_latitude,
        -74e0 + floor(c_nationkey / 5) * 0.04e0 AS pickup_longitude,
        40.6e0 + (s_nationkey % 5) * 0.05e0 AS dropoff_latitude,
        -74e0 + floor(s_nationkey / 5) * 0.04e0 AS dropoff_longitude
    FROM base
)"""

ZONES = """
zones AS (
    SELECT
        n_nationkey AS location_id,
        r_name AS borough,
        n_name AS zone,
        CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

BASIC = "duration_minutes > 0 AND trip_distance > 0 AND total_amount > 0"
PRICED = f"{BASIC} AND fare_amount > 0"
IN_HOURS = "pickup_hour BETWEEN 7 AND 10"
IN_DAYS = "pickup_day BETWEEN 12 AND 14"
NARROW = f"{BASIC} AND {IN_HOURS} AND {IN_DAYS}"

# Rows the staged raw files keep: parsable pickup time in the prepared year.
STAGED = """
staged AS (
    SELECT
        *,
        l_orderkey % 97 <> 0 AS parsable,
        year(pickup_ts) = 1998 AS in_year
    FROM trips
),
kept AS (SELECT * FROM staged WHERE parsable AND in_year)"""

BAND = """CASE WHEN pickup_hour IN (0, 1, 2, 3, 4, 5) THEN 'Night'
    WHEN pickup_hour IN (6, 7, 8, 9, 10, 11) THEN 'Morning'
    WHEN pickup_hour IN (12, 13, 14, 15, 16) THEN 'Afternoon'
    WHEN pickup_hour IN (17, 18, 19, 20, 21) THEN 'Evening'
    ELSE 'Late' END"""


def exact(expression: str) -> str:
    """Sums and averages of plain columns over decimals, which DuckDB adds without error."""

    def form(found: re.Match) -> str:
        kind, column, condition = found[1], found[2], found[3] or ""
        total = f"CAST(sum(CAST({column} AS DECIMAL(18,6))){condition} AS DOUBLE)"
        return total if kind == "sum" else f"({total} / count({column}){condition})"

    return re.sub(r"\b(sum|avg)\((\w+)\)( FILTER \([^()]*\))?(?! OVER)", form, expression)


def plain(expression: str, scale: int = 2) -> str:
    """Round the shortest decimal text of a double, half away from zero."""
    digits = f"CAST(CAST(CAST(({expression}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18))"
    return f"CAST(round({digits}, {scale}) AS DOUBLE)"


def r(expression: str, scale: int = 2) -> str:
    return plain(exact(expression), scale)


def named(scale: int, *names: str) -> str:
    return ", ".join(f"{r(name, scale)} AS {name}" for name in names)


def over_trips(body: str, *more: str) -> str:
    return "WITH " + ",".join([TRIPS, *more]) + "\n" + body


def _demand(where: str, tail: str) -> str:
    return over_trips(
        f"""
    SELECT
        pickup_date, pickup_hour, {BAND} AS time_band,
        count(*) AS trips,
        count(DISTINCT pu_location_id) AS unique_pickup_zones,
        {r("avg(passenger_count)")} AS avg_passenger_count,
        {r("avg(duration_minutes)")} AS avg_duration_minutes,
        {r("avg(trip_distance)")} AS avg_trip_distance,
        {r("avg(total_amount)")} AS avg_total_amount,
        {r("sum(total_amount)")} AS total_revenue,
        {r(f"count(*) * 100e0 / (SELECT count(*) FROM trips WHERE {where})")}
            AS trip_share_in_window
    FROM trips WHERE {where}
    GROUP BY pickup_date, pickup_hour
    {tail}"""
    )


DEMAND_TOPK = _demand(
    NARROW, "ORDER BY trips DESC, total_revenue DESC, pickup_date, pickup_hour LIMIT 17"
)

_FEES = ("mta_tax", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee")
_SURCHARGE = "extra + " + " + ".join(f"coalesce({name}, 0e0)" for name in _FEES)


def _revenue(having: str = "", tail: str = "") -> str:
    return over_trips(
        f"""
    SELECT
        borough AS pickup_borough, zone AS pickup_zone,
        CASE WHEN trip_distance >= 10 THEN 'long' WHEN trip_distance >= 3 THEN 'medium'
             WHEN trip_distance >= 1 THEN 'short' ELSE 'very_short' END AS distance_bucket,
        count(*) AS trips,
        {r("sum(total_amount)")} AS total_revenue,
        {r("avg(total_amount)")} AS avg_revenue_per_trip,
        {r("sum(total_amount) / sum(trip_distance)")} AS revenue_per_mile,
        {r("sum(total_amount) / sum(duration_minutes)")} AS revenue_per_minute,
        {r("avg(fare_amount)")} AS avg_fare_amount,
        {r("avg(tip_amount)")} AS avg_tip_amount,
        {r("sum(surcharges) / sum(total_amount)", 4)} AS surcharge_share
    FROM (SELECT *, {_SURCHARGE} AS surcharges FROM trips) JOIN zones ON pu_location_id = location_id
    WHERE {PRICED} AND {IN_HOURS}
    GROUP BY 1, 2, 3
    {having}
    {tail}""",
        ZONES,
    )


def _revenue_top(measure: str, support: int, k: int = 17) -> str:
    order = f"ORDER BY {measure} DESC, pickup_borough, pickup_zone, distance_bucket LIMIT {k}"
    return _revenue(f"HAVING count(*) >= {support}", order)


_ADAPTIVE = f"""HAVING count(*) >= (
    SELECT greatest(10, least(50, floor(count(*) * 0.01e0)))
    FROM trips WHERE {PRICED} AND {IN_HOURS})"""

_ADAPTIVE_FINE = _ADAPTIVE.replace("0.01e0", "0.004e0")

_PAID = f"{PRICED} AND {IN_HOURS} AND payment_type IN (1, 2)"

PAYMENT_HOURLY = over_trips(
    f"""
    SELECT
        pickup_hour, payment_type, count(*) AS trips,
        {r("count(*) / CAST(sum(count(*)) OVER (PARTITION BY pickup_hour) AS DOUBLE)", 4)}
            AS payment_share_in_hour,
        {r("avg(fare_amount)")} AS avg_fare_amount,
        {r("avg(total_amount)")} AS avg_total_amount,
        {r("avg(tip_amount)")} AS avg_tip_amount,
        {r("avg(rate)", 4)} AS tip_rate,
        {r("avg(CASE WHEN tip_amount = 0 THEN 1e0 ELSE 0e0 END)", 4)} AS zero_tip_share,
        {r("avg(trip_distance)")} AS avg_trip_distance,
        {r("avg(duration_minutes)")} AS avg_duration_minutes
    FROM (SELECT *, tip_amount / fare_amount AS rate FROM trips) WHERE {_PAID} GROUP BY pickup_hour, payment_type"""
)

FLAGGED = f"""
flagged AS (
    SELECT
        trips.*,
        o.borough AS pu_borough, o.zone AS pu_zone, d.borough AS do_borough, d.zone AS do_zone,
        CAST(regexp_matches(lower(o.zone), 'nation_(7|12)$') OR o.borough = 'MIDDLE EAST' AS INTEGER)
            AS pu_is_airport,
        CAST(regexp_matches(lower(d.zone), 'nation_(7|12)$') OR d.borough = 'MIDDLE EAST' AS INTEGER)
            AS do_is_airport,
        CASE WHEN pu_is_airport = 1 OR do_is_airport = 1 OR coalesce(airport_fee, 0e0) > 0
             THEN 1 ELSE 0 END AS is_airport_trip
    FROM trips
    JOIN zones o ON pu_location_id = o.location_id
    JOIN zones d ON do_location_id = d.location_id
    WHERE {BASIC} AND {IN_HOURS}
)"""

FLOWS = over_trips(
    f"""
    SELECT
        pu_borough, do_borough, count(*) AS trips,
        {r("count(*) * 100e0 / (SELECT count(*) FROM flagged)")} AS trip_share_percent,
        {r("sum(total_amount)")} AS total_revenue,
        {r("avg(total_amount)")} AS avg_total_amount,
        {r("avg(trip_distance)")} AS avg_trip_distance,
        {r("avg(duration_minutes)")} AS avg_duration_minutes,
        {r("sum(is_airport_trip) * 100e0 / count(*)")} AS airport_trip_share_percent
    FROM flagged GROUP BY pu_borough, do_borough
    ORDER BY trips DESC, pu_borough, do_borough LIMIT 17""",
    ZONES,
    FLAGGED,
)

JOINED = over_trips(
    f"""
    SELECT l_orderkey, l_linenumber, pu_location_id, borough AS pu_borough, zone AS pu_zone,
           service_zone AS pu_service_zone, {named(6, "total_amount")}
    FROM trips JOIN zones ON pu_location_id = location_id
    WHERE {BASIC} AND {IN_HOURS}""",
    ZONES,
)

BALANCE = f"""
ends AS (
    SELECT pickup_hour, pu_location_id AS location_id, 1 AS p FROM trips
    WHERE duration_minutes > 0 AND total_amount > 0 AND {IN_HOURS}
    UNION ALL
    SELECT pickup_hour, do_location_id, 0 FROM trips
    WHERE duration_minutes > 0 AND total_amount > 0 AND {IN_HOURS}
),
balance AS (
    SELECT
        pickup_hour, location_id,
        CAST(sum(p) AS BIGINT) AS pickups,
        CAST(count(*) - sum(p) AS BIGINT) AS dropoffs,
        count(*) AS activity,
        CAST(2 * sum(p) - count(*) AS BIGINT) AS net_pickups,
        CAST(2 * sum(p) - count(*) AS DOUBLE) / count(*) AS imbalance_ratio,
        abs(CAST(2 * sum(p) - count(*) AS DOUBLE) / count(*)) AS abs_imbalance_ratio
    FROM ends
    -- ends without a zone stay apart by role
    GROUP BY pickup_hour, location_id, CASE WHEN location_id IS NULL THEN p END
)"""


def _imbalance(tail: str = "") -> str:
    return over_trips(
        f"""
    SELECT balance.*, borough, zone, service_zone
    FROM balance LEFT JOIN zones ON balance.location_id = zones.location_id
    WHERE activity >= 30 {tail}""",
        ZONES,
        BALANCE,
    )


def _imbalance_top(order: str) -> str:
    return _imbalance(f"ORDER BY {order}, pickup_hour, balance.location_id NULLS FIRST LIMIT 17")


PERIODS = f"""
halves AS (
    SELECT
        pu_location_id, do_location_id, pickup_hour,
        count(*) FILTER (pickup_day <= 15) AS trips_h1,
        {exact("avg(fare_amount) FILTER (pickup_day <= 15)")} AS avg_fare_h1,
        {exact("avg(total_amount) FILTER (pickup_day <= 15)")} AS avg_total_h1,
        count(*) FILTER (pickup_day > 15) AS trips_h2,
        {exact("avg(fare_amount) FILTER (pickup_day > 15)")} AS avg_fare_h2,
        {exact("avg(total_amount) FILTER (pickup_day > 15)")} AS avg_total_h2
    FROM trips
    WHERE duration_minutes > 0 AND trip_distance > 0 AND fare_amount > 0
        AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
    GROUP BY 1, 2, 3
    HAVING trips_h1 >= 2 AND trips_h2 >= 2
)"""


def _periods(tail: str = "") -> str:
    return over_trips(
        f"""
    SELECT
        pu_location_id, do_location_id, pickup_hour,
        trips_h1, {named(6, "avg_fare_h1", "avg_total_h1")},
        trips_h2, {named(6, "avg_fare_h2", "avg_total_h2")},
        {r("(trips_h2 - trips_h1) * 100e0 / trips_h1")} AS trips_change_pct,
        {r("(halves.avg_fare_h2 - halves.avg_fare_h1) * 100e0 / halves.avg_fare_h1")}
            AS fare_change_pct
    FROM halves {tail}""",
        PERIODS,
    )


_PERIOD_TIES = "pu_location_id, do_location_id, pickup_hour LIMIT 5"

_CHORD = """pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2)
    + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
    * pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2)"""
_KM = f"12742e0 * asin(sqrt(least(1e0, {_CHORD})))"
_REAL = """pickup_latitude <> 0 AND pickup_longitude <> 0
    AND dropoff_latitude <> 0 AND dropoff_longitude <> 0"""

DISTANCES = over_trips(
    f"""
    SELECT l_orderkey, l_linenumber, pickup_hour, {r(_KM, 6)} AS haversine_km
    FROM trips WHERE {BASIC} AND {IN_HOURS} AND {_REAL}"""
)

CONGESTION = over_trips(
    f"""
    SELECT
        pickup_hour, count(*) AS total_trips,
        {r("avg(km)")} AS avg_distance_km,
        {r("avg(speed)")} AS avg_speed_kmh,
        {r("avg(CASE WHEN km / (duration_minutes / 60) < 15 THEN 100e0 ELSE 0e0 END)")}
            AS congestion_percentage
    FROM (SELECT *, {_KM} AS km, km / (duration_minutes / 60) AS speed
          FROM trips WHERE {BASIC} AND {IN_HOURS} AND {_REAL})
    WHERE km > 0 GROUP BY pickup_hour"""
)

ROUTE = over_trips(
    f"""
    SELECT
        pickup_hour, count(*) AS trips,
        {plain("avg(duration_minutes)", 6)} AS avg_duration_minutes,
        {plain("quantile_disc(duration_minutes, 0.5)", 6)} AS median_duration_minutes,
        {plain("quantile_disc(duration_minutes, 0.9)", 6)} AS p90_duration_minutes,
        {plain("avg(trip_distance_km / (duration_minutes / 60))", 6)} AS avg_speed_kmh,
        {plain("sum(trip_distance_km) / sum(duration_minutes / 60)", 6)} AS agg_speed_kmh,
        {plain("avg(km)", 6)} AS avg_haversine_km,
        {plain("avg(trip_distance_km - km)", 6)} AS avg_distance_gap_km,
        {plain("avg(CASE WHEN km > 0.2e0 THEN trip_distance_km / km END)", 6)} AS avg_detour_ratio,
        {plain("avg(CASE WHEN trip_distance_km / (duration_minutes / 60) < 10 AND trip_distance_km >= 1"
           " THEN 1e0 ELSE 0e0 END)", 6)} AS congestion_candidate_share
    FROM (SELECT *, {_KM} AS km FROM trips)
    WHERE duration_minutes > 0 AND trip_distance > 0 AND {IN_HOURS} AND year(pickup_ts) = 1998
        AND pickup_latitude BETWEEN 40e0 AND 41.5e0 AND dropoff_latitude BETWEEN 40e0 AND 41.5e0
        AND pickup_longitude BETWEEN -74.5e0 AND -73e0
        AND dropoff_longitude BETWEEN -74.5e0 AND -73e0
    GROUP BY pickup_hour"""
)

_TRIP_COLUMNS = (
    "l_orderkey l_linenumber vendor_id pickup_ts dropoff_ts passenger_count trip_distance "
    "pu_location_id do_location_id payment_type fare_amount tip_amount extra mta_tax tolls_amount "
    "improvement_surcharge congestion_surcharge airport_fee "
    "total_amount pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude "
    "pickup_date pickup_day pickup_hour duration_minutes trip_distance_km"
).split()

NULL_PROFILE = over_trips(
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, "
        f"{r(f'count(*) FILTER ({name} IS NULL) * 100e0 / count(*)')} AS null_pct FROM trips"
        for name in _TRIP_COLUMNS
    )
)


def _joinable(endpoint: str, column: str) -> str:
    return f"""
    SELECT '{endpoint}' AS endpoint, count(*) AS trips,
        count(*) FILTER (location_id IS NULL) AS unmatched,
        {r("count(location_id) * 100e0 / count(*)", 4)} AS matched_pct
    FROM trips LEFT JOIN zones ON {column} = location_id"""


def _histogram(column: str, low: int, high: int) -> str:
    return over_trips(
        f"""
    SELECT CAST(least(greatest(floor({column}), {low - 1}), {high}) AS BIGINT) AS bucket,
        count(*) AS trips
    FROM trips GROUP BY 1"""
    )


def _buckets(column: str) -> str:
    return over_trips(
        f"""
    SELECT CAST(floor({column}) AS BIGINT) AS bucket, count(*) AS trips
    FROM trips WHERE {column} IS NOT NULL GROUP BY 1"""
    )


_PREPARED = """vendor_id, pickup_ts, dropoff_ts, passenger_count, payment_type,
    pickup_date, pickup_day, pickup_hour"""

_BY_HOUR = over_trips(
    f"""
    SELECT pickup_hour, count(*) AS trips, {r("sum(total_amount)")} AS total_revenue
    FROM trips WHERE {NARROW} GROUP BY pickup_hour"""
)

_PAYMENT_COUNTS = over_trips(
    """
    SELECT payment_type, count(*) AS trips
    FROM trips WHERE payment_type IN (1, 2) GROUP BY payment_type"""
)

_AT_END = "ORDER BY trips DESC, pu_zone, do_zone LIMIT 17"

# Ids that are not numbers keep the whole column text.
ZONES_AS_TEXT = f"WITH {ZONES}" + """
    SELECT CASE WHEN location_id % 10 = 3 THEN 'N/A' ELSE CAST(location_id AS VARCHAR) END
        AS location_id, borough, zone, service_zone FROM zones"""

ORACLE: dict[str, str] = {
    "window_filter": over_trips(
        f"""
    SELECT l_orderkey, l_linenumber, pickup_ts, pickup_day, pickup_hour,
        {named(6, "duration_minutes", "trip_distance", "total_amount")}
    FROM trips WHERE {NARROW}"""
    ),
    "calendar_parts": over_trips(
        """
    SELECT l_orderkey, l_linenumber, pickup_ts, pickup_date,
        CAST(year(pickup_ts) AS INTEGER) AS pickup_year, pickup_day, pickup_hour FROM trips"""
    ),
    "trip_durations": over_trips(
        f"""
    SELECT l_orderkey, l_linenumber, {named(6, "duration_minutes", "trip_distance_km")}
    FROM trips"""
    ),
    "parse_timestamps": """
    SELECT event_id,
        CASE WHEN event_id % 3 = 0 THEN date_trunc('second', ts) END AS spaced_ts,
        CASE WHEN event_id % 3 = 1 THEN date_trunc('milliseconds', ts) END AS iso_ts
    FROM events""",
    "demand_topk": DEMAND_TOPK,
    "demand_topk_sql": DEMAND_TOPK,
    "demand_by_hour": _demand(f"{BASIC} AND {IN_HOURS}", ""),
    "time_band_summary": over_trips(
        f"""
    SELECT {BAND} AS time_band, count(*) AS total_trips,
        {r("avg(total_amount)")} AS avg_total_amount
    FROM trips WHERE {BASIC} GROUP BY 1"""
    ),
    "weekend_profile": over_trips(
        f"""
    SELECT CAST(dayofweek(pickup_date) + 1 AS INTEGER) AS weekday,
        dayofweek(pickup_date) IN (0, 6) AS is_weekend,
        count(*) AS trips, {r("avg(total_amount)")} AS avg_total_amount
    FROM trips WHERE {BASIC} AND {IN_HOURS} GROUP BY 1, 2"""
    ),
    "surcharge_components": over_trips(
        f"""
    SELECT l_orderkey, l_linenumber, {named(6, "extra")},
        {", ".join(f"{r(f'coalesce({name}, 0e0)', 6)} AS {name}" for name in _FEES)},
        {r(_SURCHARGE, 6)} AS surcharge_total
    FROM trips"""
    ),
    "revenue_by_zone_bucket": _revenue(),
    "revenue_topk": _revenue_top("total_revenue", 50),
    "revenue_topk_sql": _revenue_top("total_revenue", 50),
    "revenue_topk_per_mile": _revenue_top("revenue_per_mile", 10),
    "revenue_topk_per_minute": _revenue_top("revenue_per_minute", 10),
    "revenue_adaptive_support": _revenue(_ADAPTIVE),
    "revenue_adaptive_between": _revenue(_ADAPTIVE_FINE),
    "revenue_unsupported_extreme": _revenue_top("revenue_per_mile", 0, 1),
    "zone_revenue": over_trips(
        f"""
    SELECT zone, count(*) AS trips, {r("sum(total_amount)")} AS revenue
    FROM trips JOIN zones ON pu_location_id = location_id
    WHERE duration_minutes > 0 AND trip_distance > 0 AND {IN_HOURS} GROUP BY zone""",
        ZONES,
    ),
    "payment_counts": _PAYMENT_COUNTS,
    "payment_counts_csv": _PAYMENT_COUNTS,
    "payment_hourly": PAYMENT_HOURLY,
    "payment_hourly_sql": PAYMENT_HOURLY,
    "vendor_payment_share": over_trips(
        f"""
    SELECT vendor_id, payment_type, count(*) AS trips,
        {r("count(*) / CAST(sum(count(*)) OVER (PARTITION BY vendor_id) AS DOUBLE)", 4)}
            AS payment_share
    FROM (SELECT *, tip_amount / fare_amount AS rate FROM trips) WHERE {_PAID} GROUP BY vendor_id, payment_type"""
    ),
    "payment_card_vs_cash": over_trips(
        f"""
    SELECT
        pickup_hour,
        count(*) FILTER (payment_type = 1) AS card_trips,
        count(*) FILTER (payment_type = 2) AS cash_trips,
        {r("count(*) FILTER (payment_type = 1) / CAST(count(*) AS DOUBLE)", 4)} AS card_share,
        {r("avg(total_amount) FILTER (payment_type = 1)")} AS avg_total_card,
        {r("avg(total_amount) FILTER (payment_type = 2)")} AS avg_total_cash,
        {r("avg(fare_amount) FILTER (payment_type = 1)")} AS avg_fare_card,
        {r("avg(fare_amount) FILTER (payment_type = 2)")} AS avg_fare_cash,
        {r("avg(rate) FILTER (payment_type = 1)", 4)} AS avg_tip_rate_card
    FROM (SELECT *, tip_amount / fare_amount AS rate FROM trips) WHERE {_PAID} GROUP BY pickup_hour"""
    ),
    "special_zone_trips": over_trips(
        """
    SELECT l_orderkey, l_linenumber, pu_borough, pu_zone, do_borough, do_zone,
        pu_is_airport, do_is_airport, is_airport_trip FROM flagged""",
        ZONES,
        FLAGGED,
    ),
    "flows_by_borough": FLOWS,
    "flows_scalar_subquery": FLOWS,
    "special_zone_routes": over_trips(
        f"""
    SELECT
        pu_zone, do_zone, count(*) AS trips,
        {r("avg(coalesce(airport_fee, 0e0))")} AS avg_airport_fee,
        {r("avg(total_amount)")} AS avg_total_amount,
        {r("avg(duration_minutes)")} AS avg_duration_minutes,
        {r("avg(trip_distance)")} AS avg_trip_distance
    FROM flagged WHERE is_airport_trip = 1
    GROUP BY pu_zone, do_zone {_AT_END}""",
        ZONES,
        FLAGGED,
    ),
    "special_zone_comparison": over_trips(
        f"""
    SELECT
        is_airport_trip, count(*) AS trips,
        {r("avg(trip_distance)")} AS avg_distance,
        {r("avg(duration_minutes)")} AS avg_duration,
        {r("avg(total_amount)")} AS avg_total_amount
    FROM flagged GROUP BY is_airport_trip""",
        ZONES,
        FLAGGED,
    ),
    "join_broadcast": JOINED,
    "join_sort_merge": JOINED,
    "zone_imbalance": _imbalance(),
    "zone_imbalance_outer_join": _imbalance(),
    "imbalance_top_positive": _imbalance_top("net_pickups DESC"),
    "imbalance_top_positive_sql": _imbalance_top("net_pickups DESC"),
    "imbalance_top_negative": _imbalance_top("net_pickups"),
    "imbalance_top_abs": _imbalance_top("abs_imbalance_ratio DESC"),
    "imbalance_hourly": over_trips(
        f"""
    SELECT pickup_hour, CAST(sum(abs(net_pickups)) AS BIGINT) AS total_abs_net_pickups,
        {r("avg(abs_imbalance_ratio)", 4)} AS avg_abs_imbalance_ratio
    FROM balance GROUP BY pickup_hour""",
        BALANCE,
    ),
    "od_period_change": _periods(),
    "od_period_join": _periods(),
    "od_top_increase": _periods(f"ORDER BY trips_change_pct DESC, {_PERIOD_TIES}"),
    "od_top_decrease": _periods(f"ORDER BY trips_change_pct, {_PERIOD_TIES}"),
    "haversine_distance": DISTANCES,
    "haversine_asin": DISTANCES,
    "haversine_udf": DISTANCES,
    "congestion_by_hour": CONGESTION,
    "congestion_by_hour_udf": CONGESTION,
    "route_quality_by_hour": ROUTE,
    "route_quality_sql": ROUTE,
    "duration_percentiles": over_trips(
        f"""
    SELECT pickup_hour, quantile_disc(duration_minutes, 0.5) AS median_duration_minutes,
        quantile_disc(duration_minutes, 0.9) AS p90_duration_minutes
    FROM trips WHERE duration_minutes > 0 AND trip_distance > 0 AND {IN_HOURS}
    GROUP BY pickup_hour"""
    ),
    "null_profile": NULL_PROFILE,
    "hourly_distribution": over_trips(
        "SELECT pickup_hour, count(*) AS trips FROM trips GROUP BY pickup_hour"
    ),
    "daily_distribution": over_trips(
        "SELECT pickup_day, count(*) AS trips FROM trips GROUP BY pickup_day"
    ),
    "joinability": over_trips(
        _joinable("pickup", "pu_location_id") + " UNION ALL " + _joinable("dropoff", "do_location_id"),
        ZONES,
    ),
    "top_zones": over_trips(
        """
    SELECT zone, count(*) AS trips FROM trips LEFT JOIN zones ON pu_location_id = location_id
    GROUP BY zone ORDER BY trips DESC, zone NULLS FIRST LIMIT 10""",
        ZONES,
    ),
    "distance_histogram": _histogram("trip_distance", 1, 10),
    "amount_histogram": _histogram("total_amount", 1000, 50000),
    "distance_bucket_counts": _buckets("trip_distance"),
    "amount_bucket_counts": _buckets("total_amount"),
    "largest_trips": over_trips(
        f"""
    SELECT vendor_id, pickup_ts, {named(6, "trip_distance", "total_amount")} FROM trips
    ORDER BY trips.trip_distance DESC, vendor_id, pickup_ts, trips.total_amount LIMIT 5"""
    ),
    "longest_trips": over_trips(
        f"""
    SELECT vendor_id, pickup_ts, {named(6, "duration_minutes", "trip_distance")} FROM trips
    ORDER BY trips.duration_minutes DESC, vendor_id, pickup_ts, trips.trip_distance LIMIT 5"""
    ),
    "anomaly_samples": over_trips(
        f"""
    SELECT vendor_id, pickup_ts, {named(6, "duration_minutes", "total_amount")} FROM trips
    WHERE trips.duration_minutes = 0
    ORDER BY vendor_id, pickup_ts, trips.duration_minutes, trips.total_amount LIMIT 5"""
    ),
    "anomaly_negative_fares": over_trips(
        f"""
    SELECT vendor_id, pickup_ts, {named(6, "fare_amount", "total_amount")} FROM trips
    WHERE trips.fare_amount < 0
    ORDER BY vendor_id, pickup_ts, trips.fare_amount, trips.total_amount LIMIT 5"""
    ),
    "ingest_csv_typed": over_trips(
        f"""
    SELECT {_PREPARED}, pu_location_id, do_location_id, CAST(NULL AS INTEGER) AS rate_code_id,
        {named(6, "trip_distance_km", "duration_minutes", "airport_fee", "total_amount")}
    FROM kept""",
        STAGED,
    ),
    "ingest_csv_gps": over_trips(
        f"""
    SELECT {_PREPARED},
        {named(6, "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")},
        {named(6, "trip_distance_km", "duration_minutes", "total_amount")}
    FROM kept""",
        STAGED,
    ),
    "ingest_accounting": over_trips(
        """
    SELECT
        count(*) AS raw_rows,
        count(*) FILTER (parsable AND in_year) AS prepared_rows,
        count(*) FILTER (NOT parsable) AS null_pickup_ts_rejected,
        count(*) FILTER (parsable AND NOT in_year) AS bad_year_rejected,
        min(pickup_ts) FILTER (parsable AND in_year) AS min_pickup_ts,
        max(pickup_ts) FILTER (parsable AND in_year) AS max_pickup_ts
    FROM staged""",
        STAGED,
    ),
    "zones_typed_csv": f"WITH {ZONES}"
    + """
    SELECT CASE WHEN location_id % 10 <> 3 THEN location_id END AS location_id,
        borough, zone, service_zone FROM zones""",
    "zones_text_csv": ZONES_AS_TEXT,
    "zones_inferred_csv": ZONES_AS_TEXT,
    "csv_line_demand": over_trips(
        f"""
    SELECT pickup_date, pickup_hour, count(*) AS trips, {r("sum(total_amount)")} AS total_revenue
    FROM kept WHERE {BASIC} AND {IN_HOURS} GROUP BY pickup_date, pickup_hour
    ORDER BY trips DESC, total_revenue DESC, pickup_date, pickup_hour LIMIT 17""",
        STAGED,
    ),
    "partitioned_roundtrip": over_trips(
        f"""
    SELECT l_orderkey, l_linenumber, {_PREPARED}, pu_location_id, do_location_id,
        {named(6, "trip_distance", "total_amount")} FROM trips"""
    ),
    "pruned_scan_count": _BY_HOUR,
    "unpruned_scan_count": _BY_HOUR,
    "report_sections_json": over_trips(
        f"""
    SELECT 'hourly' AS section, CAST(pickup_hour AS VARCHAR) AS label, count(*) AS trips
    FROM trips GROUP BY pickup_hour
    UNION ALL
    SELECT 'bands', {BAND}, count(*) FROM trips WHERE {BASIC} GROUP BY 2"""
    ),
}

ORACLE |= {
    "zones_accounting": f"""
    WITH {ZONES}
    SELECT count(*) AS raw_rows,
        count(*) FILTER (location_id % 10 <> 3) AS prepared_rows,
        count(*) FILTER (location_id % 10 = 3) AS null_id_rows,
        0::BIGINT AS repeated_ids
    FROM zones""",
    "zones_overwritten": f"WITH {ZONES} SELECT location_id, borough, zone, service_zone FROM zones",
    "demand_in_order": over_trips(
        """
    SELECT pickup_hour, count(*) AS trips, row_number() OVER (ORDER BY pickup_hour) AS place
    FROM trips GROUP BY pickup_hour"""
    ),
}

# Forms of one question share its text.
ORACLE |= {
    "vendor_payment_share_sql": ORACLE["vendor_payment_share"],
    "payment_card_vs_cash_sql": ORACLE["payment_card_vs_cash"],
}

FAULTY = """
faulty AS (
    SELECT *,
        CASE WHEN l_orderkey % 109 = 0 THEN 'blank_line'
             WHEN l_orderkey % 101 = 0 THEN 'short_line'
             WHEN l_orderkey % 103 = 0 THEN 'long_line'
             WHEN l_orderkey % 89 = 0 OR l_orderkey % 83 = 0 THEN 'bad_number'
             WHEN l_orderkey % 107 = 0 THEN 'null_pickup_ts'
             WHEN l_orderkey % 97 = 0 THEN 'bad_time'
             WHEN year(pickup_ts) <> 1998 THEN 'bad_year'
             ELSE 'kept' END AS ingest_status
    FROM trips
)"""

ORACLE |= {
    "line_accounting": over_trips(
        "SELECT ingest_status, count(*) AS lines FROM faulty GROUP BY ingest_status", FAULTY
    ),
    "line_bad_fields": over_trips(
        """
    SELECT ingest_status, field, count(*) AS lines FROM (
        SELECT ingest_status, unnest([
            CASE WHEN l_orderkey % 89 = 0 THEN 'trip_distance' END,
            CASE WHEN l_orderkey % 83 = 0 THEN 'passenger_count' END,
            CASE WHEN l_orderkey % 97 = 0 AND l_orderkey % 107 <> 0 THEN 'tpep_pickup_datetime' END
        ]) AS field
        FROM faulty WHERE ingest_status NOT IN ('blank_line', 'short_line', 'long_line'))
    WHERE field IS NOT NULL GROUP BY ALL""",
        FAULTY,
    ),
    "screened_demand": over_trips(
        f"""
    SELECT pickup_hour, count(*) AS trips, {r("sum(total_amount)")} AS total_revenue
    FROM faulty WHERE ingest_status = 'kept' GROUP BY pickup_hour""",
        FAULTY,
    ),
    "partitions_replaced": over_trips(
        """
    SELECT CAST(year(pickup_ts) AS INTEGER) AS pickup_year, CAST(month(pickup_ts) AS INTEGER) AS pickup_month,
        count(*) AS trips, CAST(sum(l_orderkey) AS BIGINT) AS orders
    FROM trips WHERE year(pickup_ts) <> 1998 OR month(pickup_ts) > 3
    GROUP BY ALL"""
    ),
}

ORACLE |= {
    "calendar_scan_count": ORACLE["pruned_scan_count"],
    "join_bucketed": ORACLE["join_sort_merge"],
    "null_profile_grouped": ORACLE["null_profile"],
    "distance_histogram_grouped": ORACLE["distance_histogram"],
    "joinability_grouped": ORACLE["joinability"],
    "largest_trips_held": ORACLE["largest_trips"],
    "anomaly_samples_held": ORACLE["anomaly_samples"],
    "reach_of_windows": over_trips(
        """
    SELECT 'all' AS reach, count(DISTINCT pu_location_id) AS unique_pickup_zones FROM trips
    UNION ALL
    SELECT 'hour ' || pickup_hour, count(DISTINCT pu_location_id) FROM trips GROUP BY pickup_hour
    UNION ALL
    SELECT 'morning of ' || pickup_day, count(DISTINCT pu_location_id) FROM trips
    WHERE pickup_hour BETWEEN 7 AND 10 GROUP BY pickup_day"""
    ),
    "distance_quantiles": over_trips(
        f"""
    SELECT pickup_hour, share, count(*) AS trips, true AS within_bound
    FROM trips, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) AS s(share)
    WHERE duration_minutes > 0 AND trip_distance > 0 AND {IN_HOURS}
        AND pickup_latitude <> 0 AND pickup_longitude <> 0 AND dropoff_latitude <> 0 AND dropoff_longitude <> 0
    GROUP BY pickup_hour, share"""
    ),
}
