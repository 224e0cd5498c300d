"""Wall-clock time: parsing, calendar parts and bands.

Timestamps are TIMESTAMP_NTZ, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripfold.functions.numbers import banded

# Exclusive upper hour of each band.
TIME_BANDS = ((6, "Night"), (12, "Morning"), (17, "Afternoon"), (22, "Evening"))
LAST_TIME_BAND = "Late"

# Sunday and Saturday in Spark's one-based week.
WEEKEND = (1, 7)


def parse_wall_clock(text: Column, layout: str) -> Column:
    """Parse text of one exact layout; anything else is null, under ANSI mode too."""
    return F.when(text.rlike(layout), text.try_cast("timestamp_ntz"))


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def time_band(hour: Column) -> Column:
    return banded(hour, TIME_BANDS, LAST_TIME_BAND)


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(*WEEKEND)


def in_year(moment: Column, year: int) -> Column:
    """Whether a wall-clock time lies in a year, as bounds a Parquet scan can use."""
    first, beyond = (F.expr(f"TIMESTAMP_NTZ'{int(y):04d}-01-01 00:00:00'") for y in (year, year + 1))
    return (moment >= first) & (moment < beyond)
