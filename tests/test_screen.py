"""Every line has one fate; replaced partitions, and only those, change."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripfold import schemas
from tripfold.jobs import parser, run
from tripfold.sources import prepare, readers, screen, writers

HEADER = ",".join(line.split()[0] for line in schemas.TRIPS_ZONED_RAW.strip().splitlines())


def line(pickup="2024-11-13T08:00:00.000", dropoff="2024-11-13T08:20:00.000", passengers="1", distance="2.5", flag="N"):
    return f"1,{pickup},{dropoff},{passengers},{distance},1,{flag},7,8,1,10.0,0.5,0.5,1,0,1,14.0,2.5,"


FATES = {
    line(): "kept",
    line(flag='"N, quoted"'): "kept",
    line(passengers=""): "kept",
    line(dropoff=""): "kept",
    line(distance=" 2.5 "): "kept",
    "": "blank_line",
    "   ": "blank_line",
    ",".join(line().split(",")[:10]): "short_line",
    "not,a,trip": "short_line",
    line() + ",more": "long_line",
    line(distance="far"): "bad_number",
    line(passengers="two", distance="far", pickup="never"): "bad_number",
    line(pickup="2024-11-13 08:00:00"): "bad_time",
    line(dropoff="later"): "bad_time",
    line(pickup=""): "null_pickup_ts",
    line(pickup="2023-12-31T23:59:59.000"): "bad_year",
}


def screened(spark, path, **options):
    lines = screen.read_lines(spark, str(path), schemas.TRIPS_ZONED_RAW)
    return screen.screened_trips(lines, schemas.TRIPS_ZONED_RAW, schemas.ISO_MILLIS, 2024, **options)


@pytest.fixture
def raw(tmp_path):
    lines = list(FATES)
    for part, some in enumerate((lines[:7], lines[7:], lines[:2])):
        (tmp_path / f"part-{part}.csv").write_text("\n".join([HEADER, *some]) + "\n")
    return tmp_path


def test_every_line_has_one_fate(spark, raw):
    rows = screened(spark, raw).collect()
    expected = Counter(FATES.values()) + Counter(kept=2)
    assert Counter(r[prepare.STATUS] for r in rows) == expected
    counted = screen.line_accounting(screened(spark, raw)).collect()
    assert {r[prepare.STATUS]: r.lines for r in counted} == expected


def test_rejects_keep_their_line_and_the_unreadable_fields(spark, raw):
    found = {r[screen.LINE]: r for r in screen.rejects(screened(spark, raw)).collect()}
    assert {text: r[prepare.STATUS] for text, r in found.items()} == {t: s for t, s in FATES.items() if s != "kept"}
    assert found[line(passengers="two", distance="far", pickup="never")][screen.BAD_FIELDS] == [
        "passenger_count",
        "trip_distance",
        "tpep_pickup_datetime",
    ]
    assert found["not,a,trip"][screen.BAD_FIELDS] is None
    assert found[line(pickup="")][screen.BAD_FIELDS] == []
    assert screened(spark, raw).filter(f"{prepare.STATUS} = 'kept' AND {screen.LINE} IS NOT NULL").count() == 0


def test_kept_rows_are_those_of_the_typed_reader(spark, tmp_path):
    lines = [text for text, fate in FATES.items() if fate == "kept" and " 2.5 " not in text]
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    typed = prepare.prepared_trips(readers.read_zoned_csv(spark, str(tmp_path)), schemas.ISO_MILLIS, 2024)
    kept = screened(spark, tmp_path).drop(prepare.STATUS, screen.LINE, screen.BAD_FIELDS)
    assert dict(kept.dtypes) == dict(typed.dtypes)
    assert sorted(map(str, kept.select(*typed.columns).collect())) == sorted(map(str, typed.collect()))


def test_fewer_fields_can_make_a_line(spark, tmp_path):
    short = ",".join(line().split(",")[:17])
    (tmp_path / "a.csv").write_text("\r\n".join([HEADER, short, line()]) + "\r\n")
    rows = screened(spark, tmp_path, least_fields=17).collect()
    assert [r[prepare.STATUS] for r in rows] == ["kept", "kept"]
    assert sorted(r.congestion_surcharge is None for r in rows) == [False, True]


def test_a_mended_line_is_kept_the_next_time(spark, raw, tmp_path):
    again = tmp_path / "again"
    (
        screen.rejects(screened(spark, raw))
        .filter(F.array_contains(screen.BAD_FIELDS, "trip_distance"))
        .select(F.replace(screen.LINE, F.lit("far"), F.lit("3")))
        .write.text(str(again))
    )
    assert Counter(r[prepare.STATUS] for r in screened(spark, again).collect()) == {"kept": 1, "bad_number": 1}


# --- partition replacement ------------------------------------------------------------


BY = ("y", "d")


def table(spark, rows):
    return spark.createDataFrame(rows, "y int, d string, v int")


def files(path):
    return {f.relative_to(path): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def rows_at(spark, path):
    return Counter((r.y, r.d, r.v) for r in spark.read.parquet(str(path)).collect())


def test_only_touched_partitions_change_and_repeats_are_safe(spark, tmp_path):
    path = tmp_path / "t"
    first = [(y, d, y * 10 + i) for y in (2023, 2024) for d in ("a/b", "b") for i in range(3)]
    writers.replace_partitions(table(spark, first), str(path), *BY)
    before = files(path)
    for _ in range(2):
        writers.replace_partitions(table(spark, [(2024, "b", 7)]), str(path), *BY)
        after = files(path)
        kept = [row for row in first if row[:2] != (2024, "b")]
        assert rows_at(spark, path) == Counter([*kept, (2024, "b", 7)])
        untouched = {f for f in before if "y=2024/d=b" not in str(f)}
        assert all(after[f] == before[f] for f in untouched) and len(after) == len(untouched) + 1


def test_partitions_without_rows_any_more_are_emptied(spark, tmp_path):
    path = tmp_path / "t"
    first = [(y, d, 1) for y in (2023, 2024) for d in ("a/b", "b", None)]
    writers.replace_partitions(table(spark, first), str(path), *BY)
    writers.replace_partitions(table(spark, [(2024, "c", 2)]), str(path), *BY, within=F.col("y") == 2024)
    assert rows_at(spark, path) == Counter([(2023, "a/b", 1), (2023, "b", 1), (2023, None, 1), (2024, "c", 2)])


def test_rows_outside_replace_nothing(spark, tmp_path):
    path = tmp_path / "t"
    writers.replace_partitions(table(spark, [(2024, "a", 1)]), str(path), *BY, within=F.col("y") == 2024)
    before = files(path)
    with pytest.raises(Exception, match="row outside the replaced partitions"):
        writers.replace_partitions(
            table(spark, [(2024, "a", 2), (2023, "a", 2)]), str(path), *BY, within=F.col("y") == 2024
        )
    assert files(path) == before and rows_at(spark, path) == Counter([(2024, "a", 1)])


def section(folder, name):
    return [json.loads(text) for part in (folder / name).glob("part-*") for text in part.read_text().splitlines()]


def test_prepare_replaces_one_day_of_two_years(spark, tmp_path):
    """A day sent again, with other faults, in a table of two years."""

    def job(year, period, *lines):
        raw = tmp_path / f"raw-{year}-{period}-{len(list(tmp_path.iterdir()))}"
        raw.mkdir()
        (raw / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        arguments = ["prepare", "--raw", raw, "--year", year, "--screen", "--period", period, "--output", tmp_path / "out"]
        run(spark, parser().parse_args([str(a) for a in arguments]))

    def at(day, hour=8):
        return line(pickup=f"{day}T{hour:02d}:00:00.000", dropoff=f"{day}T{hour:02d}:20:00.000")

    job(2023, "2023-11-13", at("2023-11-13"), at("2023-11-13", 9))
    job(2024, "2024-11", at("2024-11-13"), at("2024-11-14"), "short,line")
    before = files(tmp_path / "out" / "rows")
    for _ in range(2):
        job(2024, "2024-11-13", at("2024-11-13", 10), at("2024-11-14", 10), line(distance="far"))
        trips = readers.read_trips(spark, str(tmp_path / "out" / "rows"))
        assert sorted((r.pickup_year, r.pickup_day, r.pickup_hour) for r in trips.collect()) == [
            (2023, 13, 8), (2023, 13, 9), (2024, 13, 10), (2024, 14, 8)
        ]
    after = files(tmp_path / "out" / "rows")
    assert {f: t for f, t in before.items() if "pickup_year=2024/pickup_month=11/pickup_day=13" not in str(f)}.items() <= after.items()
    accounts = section(tmp_path / "out" / "accounts" / "period=2024-11-13", "lines_by_status")
    assert {r["ingest_status"]: r["lines"] for r in accounts} == {"kept": 1, "outside_period": 1, "bad_number": 1}
    rejected = spark.read.parquet(str(tmp_path / "out" / "rejects"))
    assert Counter(r[prepare.STATUS] for r in rejected.collect()) == {"short_line": 1, "outside_period": 1, "bad_number": 1}


def test_each_line_is_parsed_once(spark, raw):
    rows = screened(spark, raw)
    kept = rows.filter(f"{prepare.STATUS} = 'kept'").groupBy("pickup_hour").count()
    for frame in (kept, screen.bad_field_counts(rows), screen.line_accounting(rows), screen.rejects(rows)):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
