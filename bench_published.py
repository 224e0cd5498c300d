"""Time whole questions at the row count of the published figures.

Repeats the prepared trips up to 41,169,664 rows, writes them partitioned by day, then times
every result table of each question, as the published timers do. Run by hand: it writes a
few gigabytes into a fresh staging folder; name that table in BENCH_TABLE to use it again,
for instance with another BENCH_CPUS. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold import reports
from tripfold.operators.congestion import CONGESTION_WINDOW
from tripfold.params import AdaptiveSupport, TripWindow
from tripfold.session import build_session
from tripfold.sources.readers import read_trips
from tripfold.sources.staging import new_folder
from tripfold.sources.writers import write_partitioned
from workbench import tables
from workbench.registry import SPECIAL

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
ROWS = int(os.environ.get("BENCH_ROWS", "41169664"))

# Published driver wall-clock in seconds, executors unknown.
PUBLISHED = {"demand": 32.5, "congestion": 47.5, "payments": 33.81, "flows": 82.91, "imbalance": 60.31}


SPREAD = ("fare_amount", "total_amount", "tip_amount", "trip_distance", "duration_minutes")


def repeated_trips(spark: SparkSession) -> DataFrame:
    """Copies of the trips; measures differ a little per copy, or the files would shrink to
    almost nothing and the scans would cost almost nothing."""
    once = tables.table(spark, SF_DIR, "lineitem").count()
    copies = -(-ROWS // once)
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    repeated = tables.trips(spark, SF_DIR).select("*", copy)
    factor = 1 + F.col("copy") * F.lit(1e-4)
    return repeated.withColumns({name: F.col(name) * factor for name in SPREAD}).drop("copy")


def main() -> None:
    spark = build_session(
        "bench-published",
        f"local[{CPUS}]",
        shuffle_partitions=CPUS * 4,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = new_folder(spark, "published-scale")
    table, write_sec = os.environ.get("BENCH_TABLE"), None
    if not table:
        table = f"{folder}/trips"
        started = time.perf_counter()
        write_partitioned(repeated_trips(spark), table, "pickup_day", sort_within=("pickup_hour",))
        write_sec = round(time.perf_counter() - started, 1)
    trips, zones = read_trips(spark, table), tables.zones(spark, SF_DIR)
    window = TripWindow()
    questions = {
        "demand": lambda out: reports.demand_report(trips, window, out),
        "congestion": lambda out: reports.congestion_report(
            trips, window.requiring(CONGESTION_WINDOW.positive)
        ),
        "revenue": lambda out: reports.revenue_report(
            trips, zones, window, out, min_support=AdaptiveSupport()
        ),
        "payments": lambda out: reports.payment_report(trips, window, out),
        "flows": lambda out: reports.flow_report(trips, zones, window, out, SPECIAL),
        "imbalance": lambda out: reports.imbalance_report(trips, zones, window, out),
        "periods": lambda out: reports.period_report(trips, out),
        "profile": lambda out: reports.profile_report(trips, zones, out),
    }
    seconds = {}
    for attempt in ("warm-up", "timed"):
        for name, build in questions.items():
            out = f"{folder}/{attempt}/{name}"
            started = time.perf_counter()
            for section in build(out).values():
                section.write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 2)
    print(
        json.dumps(
            {
                "metric": "published_scale_questions",
                "value": round(sum(seconds[name] for name in PUBLISHED), 2),
                "unit": "sec",
                "questions": seconds,
                "published": PUBLISHED,
                "rows": trips.count(),
                "table": table,
                "write_sec": write_sec,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
