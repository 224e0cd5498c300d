"""Great-circle distance, native and vectorised, and the speed measures built on it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tripfold.functions.numbers import ratio
from tripfold.params import BoundingBox

# Fixed values.
EARTH_RADIUS_KM = 6371.0
KM_PER_MILE = 1.60934

COORDINATES = (
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
)


def miles_to_km(miles: Column) -> Column:
    return miles * KM_PER_MILE


def _half_chord_squared(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine of the central angle; never negative, null when a coordinate is missing."""
    north = F.sin(F.radians(lat2 - lat1) / 2)
    east = F.sin(F.radians(lon2 - lon1) / 2)
    # Negative only for latitudes beyond a pole; the null that greatest() skips is kept by
    # the other terms.
    shrink = F.greatest(F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)), F.lit(0.0))
    return north * north + shrink * east * east


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the two-argument arctangent.

    Rounding can lift the chord a little above one; the absolute value keeps the root real.
    """
    chord = _half_chord_squared(lat1, lon1, lat2, lon2)
    return F.atan2(F.sqrt(chord), F.sqrt(F.abs(1 - chord))) * (2 * EARTH_RADIUS_KM)


def haversine_asin_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the arcsine."""
    chord = _half_chord_squared(lat1, lon1, lat2, lon2)
    held = F.when(chord > 1, 1.0).otherwise(chord)
    return F.asin(F.sqrt(held)) * (2 * EARTH_RADIUS_KM)


@pandas_udf(DoubleType())
def haversine_batch_km(
    lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series
) -> pd.Series:
    """The same distance over Arrow batches, kept to compare with the native form."""
    phi1, phi2 = np.radians(lat1), np.radians(lat2)
    north = np.sin((phi2 - phi1) / 2)
    east = np.sin(np.radians(lon2 - lon1) / 2)
    shrink = (np.cos(phi1) * np.cos(phi2)).clip(lower=0.0)
    chord = (north**2 + shrink * east**2).clip(upper=1.0)
    return 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord))


def straight_line_km() -> Column:
    return haversine_km(*(F.col(name) for name in COORDINATES))


def has_coordinates() -> Column:
    """All four coordinates present and not the zero placeholder."""
    condition = F.lit(True)
    for name in COORDINATES:
        condition = condition & (F.col(name) != 0)
    return condition


def moved() -> Column:
    """The two ends differ: true exactly when the great-circle distance is above zero.

    Comparing coordinates is cheap and reaches the scan, where a test on the distance would
    evaluate the whole formula once in the filter and again in the projection.
    """
    lat1, lon1, lat2, lon2 = (F.col(name) for name in COORDINATES)
    return (lat1 != lat2) | (lon1 != lon2)


def within(box: BoundingBox) -> Column:
    """Both ends inside the box, limits included."""
    condition = F.lit(True)
    for name in COORDINATES:
        limits = box.latitude if name.endswith("latitude") else box.longitude
        condition = condition & F.col(name).between(*limits)
    return condition


def speed_kmh(distance_km: Column, duration_minutes: Column) -> Column:
    return ratio(distance_km, duration_minutes / F.lit(60.0))


def slow_flag(
    speed: Column, below_kmh: float, distance_km: Column | None = None, from_km: float = 0.0
) -> Column:
    """1 when slower than the limit, optionally only for trips of some length; else 0."""
    slow = speed < below_kmh
    if distance_km is not None:
        slow = slow & (distance_km >= from_km)
    return F.when(slow, 1).otherwise(0)


def detour_ratio(metered_km: Column, straight_km: Column, from_km: float = 0.2) -> Column:
    """Metered over straight distance; null for trips too short to compare."""
    return F.when(straight_km > from_km, metered_km / straight_km)
