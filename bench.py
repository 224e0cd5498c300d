"""Time the headline queries; prints one JSON line.

Every figure is the median of forced full runs into the no-op sink after one warm-up, with
the variants of a pair run in turn. ``queries`` start from the given tables, joins included;
entries under ``prepared.`` start from a Parquet table of prepared trips, as the published
figures do, and those under ``csv.`` from raw text.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tripfold import schemas
from tripfold.functions import geo
from tripfold.operators import congestion, demand, flows, imbalance, payments, periods, revenue
from tripfold.operators.window import window_trips, window_trips_unpruned
from tripfold.session import build_session
from tripfold.sources import prepare, readers
from tripfold.sql import variants
from workbench import raw_files, tables
from workbench.registry import BALANCE, HOURS, NARROW, PRICED, REGISTRY, ROUTE, SPECIAL, YEAR

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
# Shuffle partitions tried for the change between periods; cores are BENCH_CPUS.
SWEEP = (1, 4, 16, 64)
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

FROM_TABLES = (
    "demand_topk",
    "congestion_by_hour",
    "route_quality_by_hour",
    "revenue_adaptive_support",
    "payment_hourly",
    "flows_by_borough",
    "zone_imbalance",
    "od_period_change",
    "null_profile",
)


def prepared_cases(spark, zones):
    trips = raw_files.read_trips_by_day(spark, SF_DIR)
    csv = readers.read_zoned_csv(spark, raw_files.zoned_csv(spark, SF_DIR))
    distance = congestion.with_haversine
    return {
        # API pair
        "prepared.demand_topk": lambda: demand.demand_topk(trips, NARROW),
        "prepared.demand_topk_sql": lambda: variants.demand_topk(trips, NARROW),
        # native against vectorised Python
        "prepared.haversine_native": lambda: distance(trips, HOURS).select("haversine_km"),
        "prepared.haversine_udf": lambda: distance(trips, HOURS, geo.haversine_batch_km).select(
            "haversine_km"
        ),
        "prepared.congestion_by_hour": lambda: congestion.congestion_by_hour(trips, HOURS),
        "prepared.route_quality": lambda: congestion.route_quality_by_hour(trips, ROUTE, YEAR),
        # partition pruning on and off
        "prepared.zone_revenue_pruned": lambda: revenue.zone_revenue_of(
            window_trips(trips, NARROW), zones
        ),
        "prepared.zone_revenue_unpruned": lambda: revenue.zone_revenue_of(
            window_trips_unpruned(trips, NARROW), zones
        ),
        "prepared.revenue_topk": lambda: revenue.revenue_topk(trips, zones, PRICED),
        "prepared.payment_hourly": lambda: payments.payment_hourly(trips, PRICED),
        # broadcast against sort-merge
        "prepared.join_broadcast": lambda: flows.pickup_zone_trips(trips, zones, HOURS),
        "prepared.join_sort_merge": lambda: flows.pickup_zone_trips(trips, zones, HOURS, "merge"),
        "prepared.flows_by_borough": lambda: flows.flows_by_borough(trips, zones, HOURS, SPECIAL),
        # one stacked aggregate against two counts and a full outer join
        "prepared.zone_imbalance": lambda: imbalance.zone_imbalance(trips, zones, BALANCE),
        "prepared.zone_imbalance_outer_join": lambda: imbalance.zone_imbalance_outer_join(
            trips, zones, BALANCE
        ),
        # one conditional aggregate against two aggregates and a join
        "prepared.od_change": lambda: periods.od_period_change(trips, min_support=2),
        "prepared.od_change_join": lambda: periods.od_period_join(trips, min_support=2),
        # the same rows over few and many shuffle partitions
        **{
            f"prepared.od_change_p{n}": spread_over(
                spark, n, lambda: periods.od_period_change(trips, min_support=2)
            )
            for n in SWEEP
        },
        # Parquet against CSV
        "prepared.payment_counts": lambda: payments.payment_counts(trips),
        "csv.payment_counts": lambda: payments.payment_counts(csv),
        "csv.demand_lines": lambda: demand.line_demand_topk(csv, schemas.ISO_MILLIS, YEAR, HOURS),
        "csv.ingest_accounting": lambda: prepare.ingest_accounting(csv, schemas.ISO_MILLIS, YEAR),
    }


def spread_over(spark, partitions: int, build):
    """Build with so many shuffle partitions, none of them coalesced."""

    def under_settings():
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        return build()

    return under_settings


def usual(spark, build):
    def under_settings():
        spark.conf.set("spark.sql.shuffle.partitions", str(CPUS))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        return build()

    return under_settings


def run_once(build) -> tuple[float, float]:
    """Seconds for everything, and for the action alone without declaring the columns."""
    started = time.perf_counter()
    frame = build()
    declared = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    ended = time.perf_counter()
    return ended - started, ended - declared


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        shuffle_partitions=CPUS,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def from_tables(name):
        return lambda: REGISTRY[name](spark, SF_DIR)

    started = time.perf_counter()
    zones = tables.zones(spark, SF_DIR)
    staged = prepared_cases(spark, zones)
    staging_sec = time.perf_counter() - started

    cases = {name: from_tables(name) for name in FROM_TABLES} | staged
    cases = {n: b if "_change_p" in n else usual(spark, b) for n, b in cases.items()}
    times = {name: [] for name in cases}
    for build in cases.values():
        run_once(build)
    for _ in range(REPEATS):
        for name, build in cases.items():
            times[name].append(run_once(build))

    def medians_of(part: int) -> dict[str, float]:
        return {
            name: round(statistics.median(run[part] for run in runs), 4)
            for name, runs in times.items()
        }

    medians = medians_of(0)
    total = sum(medians[name] for name in FROM_TABLES)
    scan_rows = tables.table(spark, SF_DIR, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 4),
                "unit": "sec",
                "queries": medians,
                "action_only": medians_of(1),
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "rows": scan_rows,
                "staging_sec": round(staging_sec, 2),
                "repeats": REPEATS,
                "cpus": CPUS,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "driver_memory": spark.conf.get("spark.driver.memory"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
