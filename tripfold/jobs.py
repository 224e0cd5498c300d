"""Command line: one subcommand per step or question."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold import reports, schemas
from tripfold.operators.congestion import CONGESTION_WINDOW, ROUTE_WINDOW
from tripfold.operators.demand import line_demand_topk
from tripfold.operators.payments import payment_counts
from tripfold.params import (
    DEFAULT_ACTIVITY,
    DEFAULT_AMOUNT_RANGE,
    DEFAULT_DAYS,
    DEFAULT_DISTANCE_RANGE,
    DEFAULT_HOURS,
    DEFAULT_K,
    DEFAULT_PERIOD_K,
    DEFAULT_PERIOD_SUPPORT,
    DEFAULT_SPLIT_DAY,
    AdaptiveSupport,
    BoundingBox,
    SpecialZones,
    TripWindow,
)
from tripfold.session import build_session
from tripfold.sources import prepare, readers, screen, writers
from tripfold.sources.staging import materialised

# How each raw kind is read, its timestamp layout, what its table is split by and its fields.
RAW_KINDS = {
    "gps": (readers.read_gps_csv, schemas.SPACED_SECONDS, "pickup_hour", schemas.TRIPS_GPS_RAW),
    "zoned": (readers.read_zoned_csv, schemas.ISO_MILLIS, "pickup_day", schemas.TRIPS_ZONED_RAW),
}
PARTITIONS = ("pickup_year", "pickup_month", "pickup_day", "pickup_hour")
NEEDS_ZONES = ("profile", "revenue", "flows", "imbalance")
# The options each question takes; one it would ignore is not offered.
QUESTIONS = {
    "profile": ("distance-range", "amount-range"),
    "demand": ("days", "hours", "k"),
    "congestion": ("days", "hours", "slow-below"),
    "route-quality": ("hours", "year", "slow-below", "slow-from", "latitudes", "longitudes"),
    "revenue": ("days", "hours", "k", "support", "support-share", "support-bounds"),
    "payments": ("days", "hours"),
    "flows": ("days", "hours", "k", "special-pattern", "special-boroughs"),
    "imbalance": ("days", "hours", "k", "min-activity"),
    "periods": ("k", "min-support", "split-day"),
}
_BOX, _ADAPTIVE, _SPECIAL = BoundingBox(), AdaptiveSupport(), SpecialZones()
OPTIONS = {
    "days": {"type": int, "nargs": "*", "default": list(DEFAULT_DAYS)},
    "hours": {"type": int, "nargs": "*", "default": list(DEFAULT_HOURS)},
    "k": {"type": int, "default": DEFAULT_K},
    "year": {"type": int},
    "distance-range": {"type": int, "nargs": 2, "default": DEFAULT_DISTANCE_RANGE},
    "amount-range": {"type": int, "nargs": 2, "default": DEFAULT_AMOUNT_RANGE},
    "slow-below": {"type": float, "help": "km/h under which a trip is slow"},
    "slow-from": {"type": float, "default": 1.0, "help": "km from which a trip can be slow"},
    "latitudes": {"type": float, "nargs": 2, "default": _BOX.latitude},
    "longitudes": {"type": float, "nargs": 2, "default": _BOX.longitude},
    "support": {"type": int, "help": "trips a group needs; by default a share of all trips"},
    "support-share": {"type": float, "default": _ADAPTIVE.share},
    "support-bounds": {"type": int, "nargs": 2, "default": (_ADAPTIVE.low, _ADAPTIVE.high)},
    "special-pattern": {"default": _SPECIAL.pattern},
    "special-boroughs": {"nargs": "*", "default": list(_SPECIAL.boroughs)},
    "min-activity": {"type": int, "default": DEFAULT_ACTIVITY},
    "min-support": {"type": int, "default": DEFAULT_PERIOD_SUPPORT},
    "split-day": {"type": int, "default": DEFAULT_SPLIT_DAY},
}
DEFAULTS = {("periods", "k"): DEFAULT_PERIOD_K, ("congestion", "slow-below"): 15.0, ("route-quality", "slow-below"): 10.0}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tripfold", description=__doc__)
    commands = root.add_subparsers(dest="command", required=True)

    ready = commands.add_parser("prepare", help="raw CSV to a partitioned Parquet table")
    ready.add_argument("--raw", required=True)
    ready.add_argument("--kind", choices=RAW_KINDS, default="zoned")
    ready.add_argument("--year", type=int, required=True)
    ready.add_argument("--partition-by", nargs="+", choices=PARTITIONS)
    ready.add_argument("--screen", action="store_true", help="turn away lines with unreadable fields, keeping them")
    ready.add_argument("--period", type=_period, help="YYYY-MM or YYYY-MM-DD: replace that month or day of the table only")
    ready.add_argument("--output", required=True)

    lookup = commands.add_parser("prepare-zones", help="zone lookup CSV to Parquet")
    lookup.add_argument("--raw", required=True)
    lookup.add_argument("--output", required=True)

    lines = commands.add_parser("demand-lines", help="busiest hours straight from raw CSV")
    lines.add_argument("--raw", required=True)
    lines.add_argument("--year", type=int, required=True)
    lines.add_argument("--output", required=True)
    _add(lines, "demand-lines", ("days", "hours", "k"))

    counts = commands.add_parser("payment-counts", help="card and cash trips, CSV or Parquet")
    counts.add_argument("--trips", required=True)
    counts.add_argument("--csv", action="store_true")
    counts.add_argument("--output", required=True)

    for name, options in QUESTIONS.items():
        question = commands.add_parser(name)
        question.add_argument("--trips", required=True)
        if name in NEEDS_ZONES:
            question.add_argument("--zones", required=True)
            question.add_argument("--zones-format", choices=("parquet", "csv"), default="parquet")
        question.add_argument("--output", required=True)
        _add(question, name, options)
    return root


def _add(command: argparse.ArgumentParser, name: str, options: Sequence[str]) -> None:
    for option in options:
        settings = dict(OPTIONS[option])
        if (name, option) in DEFAULTS:
            settings["default"] = DEFAULTS[name, option]
        command.add_argument(f"--{option}", **settings)


def _window(options: argparse.Namespace) -> TripWindow:
    """An empty list of days or hours means no restriction."""
    return TripWindow(tuple(options.days) or None, tuple(options.hours) or None)


def _period(text: str) -> tuple[int, ...]:
    parts = tuple(int(part) for part in text.split("-"))
    if len(parts) not in (2, 3):
        raise argparse.ArgumentTypeError("a period is YYYY-MM or YYYY-MM-DD")
    return parts


def _tagged(spark: SparkSession, options: argparse.Namespace) -> tuple[DataFrame, str]:
    """Every raw row with its status, and what its table is split by."""
    read, layout, split_by, schema = RAW_KINDS[options.kind]
    if options.screen:
        lines = screen.read_lines(spark, options.raw, schema)
        return screen.screened_trips(lines, schema, layout, options.year), split_by
    return prepare.tagged_trips(read(spark, options.raw), layout, options.year), split_by


def _accounts(written: DataFrame, options: argparse.Namespace) -> reports.Sections:
    accounts = {"accounting": prepare.accounting_of(written)}
    if options.screen:
        accounts["lines_by_status"] = screen.line_accounting(written)
        accounts["unreadable_fields"] = screen.bad_field_counts(written)
    return accounts


def _replace_period(spark: SparkSession, options: argparse.Namespace) -> None:
    """Put a day or month of kept trips in place of what the table has of it; the rest stays.

    Everything else the raw files hold, trips of other times included, goes to the rejects of the
    period, which are replaced as a whole, like its accounting.
    """
    names = tuple(prepare.PERIOD)[: len(options.period)]
    within = F.lit(True)
    for name, value in zip(names, options.period):
        within = within & (F.col(name) == value)
    label = "-".join(f"{part:02d}" for part in options.period)
    tagged, _ = _tagged(spark, options)
    for name, part in prepare.PERIOD.items():
        tagged = tagged.withColumn(name, part(F.col("pickup_ts")))
    outside = (F.col(prepare.STATUS) == prepare.KEPT) & ~within
    status = F.when(outside, prepare.OUTSIDE_PERIOD).otherwise(F.col(prepare.STATUS))
    incoming = materialised(
        tagged.withColumn(prepare.STATUS, status), f"{options.output}/_incoming/period={label}"
    )
    kept = incoming.filter(F.col(prepare.STATUS) == prepare.KEPT).drop(screen.LINE, screen.BAD_FIELDS)
    writers.replace_partitions(
        kept,
        f"{options.output}/rows",
        prepare.STATUS,
        *prepare.PERIOD,
        sort_within=("pickup_hour",),
        within=within & (F.col(prepare.STATUS) == prepare.KEPT),
    )
    turned_away = incoming.filter(F.col(prepare.STATUS) != prepare.KEPT)
    writers.write_table(turned_away, f"{options.output}/rejects/period={label}")
    writers.write_sections(_accounts(incoming, options), f"{options.output}/accounts/period={label}")


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    output = options.output
    if options.command == "prepare" and options.period:
        _replace_period(spark, options)
    elif options.command == "prepare":
        tagged, split_by = _tagged(spark, options)
        by = options.partition_by or [split_by]
        for name in by:
            if name in prepare.CALENDAR:
                tagged = tagged.withColumn(name, prepare.CALENDAR[name](F.col("pickup_ts")))
        # Rejects go to partitions of their own: one pass over the text serves the trips,
        # the accounting and whoever wants to look at the rejects.
        table = f"{output}/rows"
        inside = tuple(name for name in ("pickup_hour",) if name not in by)
        writers.write_partitioned(tagged, table, prepare.STATUS, *by, sort_within=inside)
        written = readers.read_rows(spark, table)
        writers.write_sections(_accounts(written, options), output)
    elif options.command == "prepare-zones":
        writers.write_table(readers.read_zones_csv(spark, options.raw), output)
        written = readers.read_zones(spark, output)
        # Readers of the table pass over folders that begin with an underscore.
        writers.write_sections({"_accounting": prepare.zone_accounting(written)}, output)
    elif options.command == "demand-lines":
        raw = readers.read_zoned_csv(spark, options.raw)
        window = _window(options)
        top = line_demand_topk(raw, schemas.ISO_MILLIS, options.year, window, options.k)
        writers.write_sections({"top_demand_hours": top}, output)
    elif options.command == "payment-counts":
        read = readers.read_zoned_csv if options.csv else readers.read_trips
        counts = payment_counts(read(spark, options.trips))
        writers.write_sections({"payment_counts": counts}, output)
    else:
        writers.write_sections(_sections(spark, options), output)


def _sections(spark: SparkSession, options: argparse.Namespace) -> reports.Sections:
    trips, folder = readers.read_trips(spark, options.trips), options.output
    zones = None
    if "zones" in options:
        zones = readers.read_zones(spark, options.zones, options.zones_format)
    window = _window(options) if "days" in options else None
    match options.command:
        case "profile":
            ranges = tuple(options.distance_range), tuple(options.amount_range)
            return reports.profile_report(trips, zones, folder, *ranges)
        case "demand":
            return reports.demand_report(trips, window, folder, options.k)
        case "congestion":
            required = window.requiring(CONGESTION_WINDOW.positive)
            return reports.congestion_report(trips, required, options.slow_below)
        case "route-quality":
            hours_only = TripWindow(None, tuple(options.hours) or None, ROUTE_WINDOW.positive)
            box = BoundingBox(tuple(options.latitudes), tuple(options.longitudes))
            return reports.route_quality_report(
                trips, hours_only, options.year, box, options.slow_below, options.slow_from
            )
        case "revenue":
            support = options.support
            if support is None:
                support = AdaptiveSupport(options.support_share, *options.support_bounds)
            return reports.revenue_report(trips, zones, window, folder, options.k, support)
        case "payments":
            return reports.payment_report(trips, window, folder)
        case "flows":
            rule = SpecialZones(options.special_pattern, tuple(options.special_boroughs))
            return reports.flow_report(trips, zones, window, folder, rule, options.k)
        case "imbalance":
            return reports.imbalance_report(
                trips, zones, window, folder, options.min_activity, options.k
            )
        case _:
            return reports.period_report(
                trips, folder, options.min_support, options.k, options.split_day
            )


def main(arguments: Sequence[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    run(build_session(f"tripfold-{options.command}"), options)


if __name__ == "__main__":
    main()
