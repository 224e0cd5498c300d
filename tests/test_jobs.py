"""The command line from raw CSV to report sections."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from tripfold.jobs import NEEDS_ZONES, QUESTIONS, parser, run
from tripfold.sources.readers import read_trips
from workbench import raw_files

TRIPS = "rows"


def section(output, name):
    parts = sorted(Path(output, name).glob("*.json"))
    return [json.loads(text) for part in parts for text in part.read_text().splitlines()]


@pytest.fixture(scope="module")
def ready(spark, sf_dir, tmp_path_factory):
    """Both kinds of raw trips and the zones, prepared through the command line."""
    base = tmp_path_factory.mktemp("jobs")
    csv, gps = raw_files.zoned_csv(spark, sf_dir), raw_files.gps_csv(spark, sf_dir)
    zones = raw_files.zones_csv(spark, sf_dir)

    def job(*arguments):
        run(spark, parser().parse_args([str(a) for a in arguments]))

    job("prepare", "--raw", csv, "--year", 1998, "--output", base / "zoned")
    job("prepare", "--raw", gps, "--kind", "gps", "--year", 1998, "--output", base / "gps")
    job("prepare-zones", "--raw", zones, "--output", base / "zones")
    return base, job, csv


def test_prepared_tables(spark, ready):
    base, _, _ = ready
    (accounting,) = section(base / "zoned", "accounting")
    assert accounting["prepared_rows"] == read_trips(spark, str(base / "zoned" / TRIPS)).count()
    assert accounting["raw_rows"] == 6000
    assert len(list((base / "zoned" / TRIPS / "ingest_status=kept").glob("pickup_day=*"))) == 31
    assert len(list((base / "gps" / TRIPS / "ingest_status=kept").glob("pickup_hour=*"))) == 24
    rejects = spark.read.parquet(str(base / "zoned" / "rows")).filter("ingest_status <> 'kept'")
    assert rejects.count() == accounting["raw_rows"] - accounting["prepared_rows"]


@pytest.mark.parametrize("question", QUESTIONS)
def test_question(ready, question):
    base, job, _ = ready
    kind = "gps" if question in ("congestion", "route-quality") else "zoned"
    arguments = [question, "--trips", base / kind / TRIPS, "--output", base / "out" / question]
    if question in NEEDS_ZONES:
        arguments += ["--zones", base / "zones"]
    offered = {"days": ["--days"], "k": ["--k", 5]}
    for option in QUESTIONS[question]:
        arguments += offered.get(option, [])
    job(*arguments)
    written = {
        folder.name: section(base / "out" / question, folder.name)
        for folder in (base / "out" / question).iterdir()
        if not folder.name.startswith("_")
    }
    assert written
    may_be_empty = {"negative_fare", "zero_duration", "top_increases", "top_decreases"}
    if question in ("revenue", "imbalance"):  # few groups reach the thresholds at this scale
        may_be_empty |= {name for name in written if name.startswith("top_")}
    assert all(rows or name in may_be_empty for name, rows in written.items()), written.keys()


def test_raw_jobs(ready):
    base, job, csv = ready
    job("demand-lines", "--raw", csv, "--year", 1998, "--days", "--output", base / "lines")
    assert len(section(base / "lines", "top_demand_hours")) == 17
    job("payment-counts", "--trips", csv, "--csv", "--output", base / "from_csv")
    job("payment-counts", "--trips", base / "zoned" / TRIPS, "--output", base / "from_parquet")
    assert {row["payment_type"] for row in section(base / "from_csv", "payment_counts")} == {1, 2}
    assert {row["payment_type"] for row in section(base / "from_parquet", "payment_counts")} == {1, 2}


def test_histograms_hold_every_row(ready):
    base, _, _ = ready
    (accounting,) = section(base / "zoned", "accounting")
    for name in ("trip_distance_histogram", "total_amount_histogram"):
        buckets = section(base / "out" / "profile", name)
        assert sum(row["trips"] for row in buckets) == accounting["prepared_rows"]


def test_kept_rows_are_read_from_either_path(ready):
    base, job, _ = ready
    counts = {}
    for name, path in (("all", "rows"), ("kept", "rows/ingest_status=kept")):
        job("demand", "--trips", base / "zoned" / path, "--days", "--output", base / "paths" / name)
        counts[name] = sorted(map(str, section(base / "paths" / name, "top_demand_hours")))
    assert counts["all"] == counts["kept"] and counts["all"]


# Per question: an option with a value, the section it changes, and what holds there.
EFFECTS = [
    ("demand", ["--k", 3], "top_demand_hours", lambda rows: len(rows) == 3),
    ("demand", ["--hours", 5], "top_demand_hours", lambda rows: {r["pickup_hour"] for r in rows} == {5}),
    ("profile", ["--distance-range", 2, 4], "trip_distance_histogram", lambda rows: {r.get("bucket") for r in rows} <= {1, 2, 3, 4, None}),
    ("profile", ["--amount-range", 0, 1], "total_amount_histogram", lambda rows: {r.get("bucket") for r in rows} <= {-1, 0, 1, None}),
    ("congestion", ["--slow-below", 1e9], "hourly_metrics", lambda rows: rows and all(r["congestion_percentage"] == 100 for r in rows)),
    ("route-quality", ["--slow-below", 1e9, "--slow-from", 0], "summary", lambda rows: rows and all(r["congestion_candidate_share"] == 1 for r in rows)),
    ("route-quality", ["--year", 1997], "summary", lambda rows: rows == []),
    ("route-quality", ["--latitudes", 0, 1], "summary", lambda rows: rows == []),
    ("route-quality", ["--longitudes", 0, 1], "summary", lambda rows: rows == []),
    ("revenue", ["--support", 1], "support_threshold", lambda rows: [r["support_threshold"] for r in rows] == [1]),
    ("revenue", ["--support-share", 1, "--support-bounds", 3, 7], "support_threshold", lambda rows: [r["support_threshold"] for r in rows] == [7]),
    ("flows", ["--special-pattern", "nothing has this name", "--special-boroughs"], "top_airport_routes", lambda rows: all(r["avg_airport_fee"] > 0 for r in rows)),
    ("imbalance", ["--min-activity", 1], "top_abs_imbalance_ratio", lambda rows: len(rows) == 17),
    ("periods", ["--min-support", 1, "--k", 2], "top_increases", lambda rows: len(rows) == 2),
    ("periods", ["--min-support", 1, "--split-day", 31], "top_increases", lambda rows: rows == []),
    ("payments", ["--hours", 5], "hourly_payment_stats", lambda rows: {r["pickup_hour"] for r in rows} <= {5}),
]


@pytest.mark.parametrize("question,given,name,holds", EFFECTS)
def test_every_option_has_an_effect(ready, tmp_path, question, given, name, holds):
    base, job, _ = ready
    kind = "gps" if question in ("congestion", "route-quality") else "zoned"
    arguments = [question, "--trips", base / kind / TRIPS, "--output", tmp_path]
    if question in NEEDS_ZONES:
        arguments += ["--zones", base / "zones"]
    if "days" in QUESTIONS[question]:
        arguments.append("--days")
    job(*arguments, *given)
    assert holds(section(tmp_path, name))


@pytest.mark.parametrize("question,option", [("profile", "--k"), ("periods", "--days"), ("demand", "--year")])
def test_options_a_question_would_ignore_are_refused(question, option):
    with pytest.raises(SystemExit):
        parser().parse_args([question, "--trips", "t", "--zones", "z", "--output", "o", option, "1"])


def test_partitions_by_year_and_month(spark, ready, tmp_path):
    _, job, csv = ready
    by = ["pickup_year", "pickup_month", "pickup_day"]
    job("prepare", "--raw", csv, "--year", 1998, "--partition-by", *by, "--output", tmp_path)
    kept = tmp_path / "rows" / "ingest_status=kept" / "pickup_year=1998"
    assert len(list(kept.glob("pickup_month=*"))) > 1
    (accounting,) = section(tmp_path, "accounting")
    assert read_trips(spark, str(tmp_path / "rows")).count() == accounting["prepared_rows"]


def test_zone_lookup_is_accounted_for(ready):
    base, _, _ = ready
    (row,) = section(base / "zones", "_accounting")
    assert row["raw_rows"] == row["prepared_rows"] + row["null_id_rows"] == 25
