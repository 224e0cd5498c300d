"""Two-level aggregation: by compact keys first, by final labels later.

The fact rows are reduced to sums and counts per integer key before any name is joined on, so
the fact side of a dimension join is a small table, hot keys collapse in the map-side
partial aggregate, and no raw row is ever shuffled by a skewed label.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripfold.functions.numbers import MONEY, Grain, exact_avg, joined_sum, ratio, rounded, sum_parts


def partials(measures: Iterable[str], grain: Grain = MONEY) -> list[Column]:
    """Mergeable state per measure: the parts of an exact sum and the number of non-null values."""
    state = []
    for name in measures:
        for part, total in sum_parts(F.col(name), grain).items():
            state.append(total.alias(f"{name}__{part}"))
        state.append(F.count(name).alias(f"{name}__n"))
    return state


def merged_sum(name: str, where: Column | None = None, grain: Grain = MONEY) -> Column:
    """Sum over merged groups, or over those that meet a condition."""

    def part(suffix: str) -> Column:
        value = F.col(f"{name}__{suffix}")
        return F.sum(value if where is None else F.when(where, value))

    return joined_sum(part("high"), part("low"), part("odd"), grain)


def merged_avg(name: str, where: Column | None = None, grain: Grain = MONEY) -> Column:
    counted = F.col(f"{name}__n")
    whole = F.sum(counted if where is None else F.when(where, counted))
    return ratio(merged_sum(name, where, grain), whole)


def merged_ratio(numerator: str, denominator: str) -> Column:
    return ratio(merged_sum(numerator), merged_sum(denominator))


def mean(name: str, scale: int = 2, grain: Grain = MONEY) -> Column:
    """Rounded average over the rows of a single-level group."""
    return rounded(exact_avg(F.col(name), grain), scale)


def with_total(groups: DataFrame, count: str, total: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Add the total of ``count`` over all groups, or over groups sharing ``within``.

    Takes rows that are already aggregated by calendar or dimension keys: a table whose size
    is set by the key domain (hours, zones, boroughs), not by the number of facts. That keeps
    the facts at one scan, where a scalar subquery would read them a second time.
    """
    return groups.withColumn(total, F.sum(count).over(Window.partitionBy(*within)))
