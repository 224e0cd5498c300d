"""Trip classes and money measures."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.functions.numbers import banded, optional_amount, ratio
from tripfold.schemas import SURCHARGES

# Exclusive upper distance of each bucket, in miles.
DISTANCE_BUCKETS = ((1, "very_short"), (3, "short"), (10, "medium"))
LAST_DISTANCE_BUCKET = "long"

# Payment codes.
CARD = 1
CASH = 2


def distance_bucket(miles: Column) -> Column:
    """Distance class; a missing distance has none."""
    return F.when(miles.isNotNull(), banded(miles, DISTANCE_BUCKETS, LAST_DISTANCE_BUCKET))


def surcharge_total(frame: DataFrame) -> Column:
    """Sum of all surcharge components, missing ones as zero."""
    return reduce(add, (optional_amount(frame, name) for name in SURCHARGES))


def tip_rate(card_only: bool = False) -> Column:
    rate = ratio(F.col("tip_amount"), F.col("fare_amount"))
    return F.when(F.col("payment_type") == CARD, rate) if card_only else rate


def zero_tip_flag() -> Column:
    return F.when(F.col("tip_amount") == 0, 1.0).otherwise(0.0)
