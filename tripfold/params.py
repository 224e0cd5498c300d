"""Query parameters as frozen values, shared by the DataFrame and the SQL variants."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Which measures must be positive, per question.
POSITIVE_BASIC = ("duration_minutes", "trip_distance", "total_amount")
POSITIVE_PRICED = ("duration_minutes", "trip_distance", "fare_amount", "total_amount")
POSITIVE_BALANCE = ("duration_minutes", "total_amount")
POSITIVE_PERIOD = ("duration_minutes", "trip_distance", "fare_amount")
POSITIVE_ROUTE = ("duration_minutes", "trip_distance")

# The parameters the published results were computed with.
DEFAULT_DAYS = (12, 13, 14)
DEFAULT_HOURS = (7, 8, 9, 10)
DEFAULT_K = 17
DEFAULT_SUPPORT = 50
DEFAULT_ACTIVITY = 30
DEFAULT_PERIOD_SUPPORT = 50
DEFAULT_PERIOD_K = 5
DEFAULT_SPLIT_DAY = 15

# Unit buckets of the profile histograms; what lies outside counts in one on either side.
DEFAULT_DISTANCE_RANGE = (0, 100)
DEFAULT_AMOUNT_RANGE = (0, 200)


def wrapped_hours(start_hour: int, length: int) -> tuple[int, ...]:
    """Return ``length`` hours of the day from ``start_hour``, wrapping past midnight."""
    if not 0 < length <= 24:
        raise ValueError(f"length must be between 1 and 24, got {length}")
    return tuple((start_hour + step) % 24 for step in range(length))


@dataclass(frozen=True)
class TripWindow:
    """Calendar window plus validity rule; ``None`` means no restriction on that part."""

    days: tuple[int, ...] | None = DEFAULT_DAYS
    hours: tuple[int, ...] | None = DEFAULT_HOURS
    positive: tuple[str, ...] = POSITIVE_BASIC

    def __post_init__(self) -> None:
        if self.days is not None and not all(1 <= day <= 31 for day in self.days):
            raise ValueError(f"days must lie in 1..31, got {self.days}")
        if self.hours is not None and not all(0 <= hour <= 23 for hour in self.hours):
            raise ValueError(f"hours must lie in 0..23, got {self.hours}")

    @classmethod
    def starting(cls, start_hour: int, length: int, **other) -> TripWindow:
        return cls(hours=wrapped_hours(start_hour, length), **other)

    def requiring(self, positive: tuple[str, ...]) -> TripWindow:
        return replace(self, positive=positive)


@dataclass(frozen=True)
class SpecialZones:
    """Rule that marks a zone as special (an airport, by default)."""

    pattern: str = "jfk|laguardia|newark|airport"
    boroughs: tuple[str, ...] = ("EWR",)


@dataclass(frozen=True)
class AdaptiveSupport:
    """Support threshold that follows the data: a share of all rows, held within bounds."""

    share: float = 0.01
    low: int = 10
    high: int = 50


@dataclass(frozen=True)
class BoundingBox:
    """Inclusive coordinate limits, applied to both ends of a trip."""

    latitude: tuple[float, float] = (40.0, 41.5)
    longitude: tuple[float, float] = (-74.5, -73.0)
