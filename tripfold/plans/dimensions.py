"""Joins with the zone dimension.

No broadcast is forced. Spark compares the size of the dimension with
``spark.sql.autoBroadcastJoinThreshold``, at planning time and again at run time from the
real shuffle size, and sorts and merges beyond it; adaptive skew-join handling then splits a
hot zone over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripfold.params import SpecialZones

# Catalyst join hints an experiment may ask for; ``auto`` leaves the choice to Spark.
STRATEGIES = {"auto": None, "merge": "merge", "shuffle_hash": "shuffle_hash"}


def unique_zones(zones: DataFrame) -> DataFrame:
    """The dimension, failing when used if an id is listed twice: it would multiply trips."""
    others = [name for name in zones.columns if name != "location_id"]
    location = F.col("location_id")
    message = F.concat(F.lit("zone id listed more than once: "), location.cast("string"))
    repeated = location.isNotNull() & (F.col("zone__entries") > 1)
    return (
        zones.groupBy("location_id")
        .agg(F.count("*").alias("zone__entries"), *(F.first(name).alias(name) for name in others))
        .withColumn("location_id", F.when(repeated, F.raise_error(message)).otherwise(location))
        .drop("zone__entries")
    )


def zone_role(zones: DataFrame, role: str, *columns: str, checked: bool = False) -> DataFrame:
    """The dimension under the names of one role: ``pu`` gives pu_location_id, pu_zone, …

    ``checked`` says its ids were found unique when it was stored, so it is used as it lies.
    """
    wanted = columns or ("borough", "zone")
    return (zones if checked else unique_zones(zones)).select(
        F.col("location_id").alias(f"{role}_location_id"),
        *(F.col(name).alias(f"{role}_{name}") for name in wanted),
    )


def join_zone(
    facts: DataFrame,
    zones: DataFrame,
    role: str,
    *columns: str,
    strategy: str = "auto",
    how: str = "inner",
    checked: bool = False,
) -> DataFrame:
    """Join on the zone id of a role; facts of unknown zones drop out, or stay with ``left``."""
    side = zone_role(zones, role, *columns, checked=checked)
    hint = STRATEGIES[strategy]
    if hint is not None:
        side = side.hint(hint)
    return facts.join(side, f"{role}_location_id", how)


def special_zones(zones: DataFrame, rule: SpecialZones) -> DataFrame:
    """Add ``is_special``; the rule is evaluated once per zone, not once per trip."""
    named = F.lower(F.col("zone")).rlike(rule.pattern)
    placed = F.col("borough").isin(*rule.boroughs)
    return zones.withColumn(
        "is_special", F.coalesce(named, F.lit(False)) | F.coalesce(placed, F.lit(False))
    )


def duplicate_zone_ids(zones: DataFrame) -> DataFrame:
    """Zone ids listed more than once; each would multiply the trips joined to it."""
    return zones.groupBy("location_id").agg(F.count("*").alias("entries")).filter("entries > 1")
