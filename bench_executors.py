"""The same plans under 1, 2 and 4 executor processes; run by hand, prints one JSON line.

Executors are processes of their own on this machine (``local-cluster``), each with its own memory and
shuffle files, started one setting after the other. Per query: median seconds, and the
megabytes written to shuffles and read from other executors, from the event log.
"""

from __future__ import annotations

import json
import os
import statistics
import subprocess
import sys
import tempfile
import time
from pathlib import Path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
EXECUTORS = tuple(int(n) for n in os.environ.get("BENCH_EXECUTORS", "1,2,4").split(","))
CORES = int(os.environ.get("BENCH_EXECUTOR_CORES", "2"))
MEMORY = int(os.environ.get("BENCH_EXECUTOR_MB", "2000"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def one_setting(executors: int, folder: str) -> None:
    from tripfold.operators import demand, flows, periods, profile
    from tripfold.session import build_session
    from tripfold.sources.readers import read_trips
    from workbench import raw_files, tables
    from workbench.registry import HOURS, SPECIAL

    spark = build_session(
        f"executors-{executors}",
        f"local-cluster[{executors},{CORES},{MEMORY}]",
        shuffle_partitions=executors * CORES,
        **{
            "spark.executor.memory": f"{MEMORY}m",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file://{folder}/shared",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{folder}/events",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    trips = read_trips(spark, raw_files.trips_by_day(spark, SF_DIR))
    zones = tables.zones(spark, SF_DIR)
    cases = {
        "od_period_change": lambda: periods.od_period_change(trips, min_support=2),
        "flows_by_borough": lambda: flows.flows_by_borough(trips, zones, HOURS, SPECIAL),
        "demand_by_hour": lambda: demand.demand_by_hour(trips, HOURS),
        "profile_counts": lambda: profile.tagged_counts(trips, {"trip_distance": (0, 50)}),
    }
    times: dict[str, list[float]] = {name: [] for name in cases}
    for turn in range(REPEATS + 1):
        for name, build in cases.items():
            spark.sparkContext.setJobGroup(f"{name}/{turn}", name)
            started = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            if turn:
                times[name].append(time.perf_counter() - started)
    spark.stop()
    moved = shuffled(Path(folder) / "events")
    print(json.dumps({n: {"sec": round(statistics.median(t), 3), **moved.get(f"{n}/{REPEATS}", {})} for n, t in times.items()}))


def shuffled(events: Path) -> dict[str, dict[str, float]]:
    """Megabytes written to shuffles and read from other executors, by job group."""
    group_of: dict[int, str] = {}
    sums: dict[str, dict[str, float]] = {}
    for log in events.iterdir():
        for line in log.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                group_of |= {stage: group for stage in event["Stage IDs"] if group}
            elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in group_of:
                metrics = event.get("Task Metrics") or {}
                own = sums.setdefault(group_of[event["Stage ID"]], {"shuffle_mb": 0.0, "remote_mb": 0.0})
                own["shuffle_mb"] += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
                own["remote_mb"] += metrics.get("Shuffle Read Metrics", {}).get("Remote Bytes Read", 0) / 1e6
    return {group: {name: round(value, 3) for name, value in own.items()} for group, own in sums.items()}


def main() -> None:
    if len(sys.argv) == 3:
        one_setting(int(sys.argv[1]), sys.argv[2])
        return
    found = {}
    for executors in EXECUTORS:
        folder = tempfile.mkdtemp(prefix="executors-")
        os.makedirs(f"{folder}/events")
        env = os.environ | {"PYTHONPATH": str(Path(__file__).parent)}
        run = subprocess.run(
            [sys.executable, __file__, str(executors), folder], env=env, capture_output=True, text=True, check=True
        )
        found[executors] = json.loads(run.stdout.strip().splitlines()[-1])
    print(json.dumps({"sf": SF_DIR, "cores_per_executor": CORES, "executors": found}))


if __name__ == "__main__":
    main()
