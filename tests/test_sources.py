from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripfold import schemas
from tripfold.operators.demand import line_demand_topk
from tripfold.params import TripWindow
from tripfold.sources import prepare, readers, staging, writers
from tripfold.streaming import ingest

HEADER = ",".join(line.split()[0] for line in schemas.TRIPS_ZONED_RAW.strip().splitlines())


def line(pickup, dropoff="2024-11-13T08:20:00.000", distance="2.5", total="14.0", zone="7"):
    return f"1,{pickup},{dropoff},,{distance},1,N,{zone},8,1,10.0,0.5,0.5,1,0,1,{total},2.5,"


GOOD = line("2024-11-13T08:00:00.000")
LINES = [
    GOOD,
    line("2024-11-13T08:05:00.000", total="16.0"),
    line("2024-12-31T23:59:59.999", dropoff="2025-01-01T00:09:59.999"),
    line("2023-12-31T23:59:59.000"),
    line("2025-01-01T00:00:00.000"),
    line("bad"),
    line(""),
    line("2024-11-13 08:00:00"),
    line("2024-11-13T08:00:00.000", distance="far"),
    line("2024-11-13T08:00:00.000", zone="n/a"),
    line("2024-11-13T08:00:00.000", dropoff="2024-11-13T07:00:00.000"),
    ",".join(GOOD.split(",")[:10]),
]


@pytest.fixture
def zoned(spark, tmp_path):
    for part, lines in enumerate((LINES[:6], LINES[6:])):
        (tmp_path / f"part-{part}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return readers.read_zoned_csv(spark, str(tmp_path))


def test_header_of_every_file_is_dropped(zoned):
    assert zoned.count() == len(LINES)
    assert zoned.filter("tpep_pickup_datetime like 'tpep%'").count() == 0


def test_accounting_adds_up(zoned):
    row = prepare.ingest_accounting(zoned, schemas.ISO_MILLIS, 2024).first()
    assert row.raw_rows == len(LINES)
    assert (row.null_pickup_ts_rejected, row.bad_year_rejected) == (3, 2)
    assert row.raw_rows == row.prepared_rows + row.null_pickup_ts_rejected + row.bad_year_rejected
    assert row.min_pickup_ts == dt.datetime(2024, 11, 13, 8)
    assert row.max_pickup_ts == dt.datetime(2024, 12, 31, 23, 59, 59, 999000)


def test_accounting_of_nothing(zoned):
    row = prepare.ingest_accounting(zoned.limit(0), schemas.ISO_MILLIS, 2024).first()
    assert tuple(row) == (0, 0, 0, 0, None, None)


def test_prepared_columns(zoned):
    ready = prepare.prepared_trips(zoned, schemas.ISO_MILLIS, 2024)
    assert set(ready.columns) == {
        *"vendor_id tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance".split(),
        *"rate_code_id store_and_fwd_flag pu_location_id do_location_id payment_type".split(),
        *"fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge".split(),
        *"total_amount congestion_surcharge airport_fee pickup_ts dropoff_ts pickup_date".split(),
        *"pickup_day pickup_hour duration_minutes trip_distance_km".split(),
    }
    newest = ready.orderBy(F.desc("pickup_ts")).first()
    assert (newest.pickup_day, newest.pickup_hour, newest.duration_minutes) == (31, 23, 10.0)
    assert newest.trip_distance_km == pytest.approx(2.5 * 1.60934)


def test_bad_lines_drop_out_of_the_demand(zoned):
    """Malformed distance, negative duration and a short line go; a malformed zone id stays."""
    top = line_demand_topk(zoned, schemas.ISO_MILLIS, 2024, TripWindow())
    assert [tuple(row) for row in top.collect()] == [(dt.date(2024, 11, 13), 8, 3, 44.0)]


def test_zone_lookup_types(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, NJ",EWR\nN/A,Queens,X,Y\n')
    declared = readers.read_zones(spark, str(path), "csv")
    assert [tuple(row) for row in declared.collect()] == [
        (1, "EWR", "Newark, NJ", "EWR"),
        (None, "Queens", "X", "Y"),
    ]
    text = readers.read_zones_csv(spark, str(path), types="text")
    assert dict(text.dtypes)["location_id"] == "string" and text.count() == 2
    inferred = readers.read_zones_csv(spark, str(path), types="inferred")
    assert dict(inferred.dtypes)["location_id"] == "string"
    writers.write_table(declared, str(tmp_path / "zones"))
    assert readers.read_zones(spark, str(tmp_path / "zones")).count() == 2
    declared.write.option("header", True).csv(str(tmp_path / "folder of csv"))
    folder = readers.read_zones(spark, str(tmp_path / "folder of csv"), "csv")
    assert folder.where("zone = 'Newark, NJ'").count() == 1
    with pytest.raises(ValueError):
        readers.read_zones(spark, str(path), "json")


def test_zone_accounting(spark):
    zones = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "location_id int, zone string")
    assert tuple(prepare.zone_accounting(zones).first()) == (4, 3, 1, 1)
    assert tuple(prepare.zone_accounting(zones.limit(0)).first()) == (0, 0, 0, 0)


def test_partitioned_write_splits_a_hot_day_and_joins_small_ones(spark, tmp_path, setting):
    setting(spark__sql__adaptive__advisoryPartitionSizeInBytes="200k", spark__sql__shuffle__partitions="200")
    frame = spark.range(0, 300000, 1, 8).select(
        F.col("id"),
        F.when(F.col("id") % 3 > 0, 13).otherwise(F.col("id") % 31 + 1).cast("int").alias("pickup_day"),
    )
    path = str(tmp_path / "table")
    writers.write_partitioned(frame, path, "pickup_day", sort_within=("id",))
    files = {
        int(folder.name.split("=")[1]): len(list(folder.glob("*.parquet")))
        for folder in Path(path).glob("pickup_day=*")
    }
    assert len(files) == 31
    assert files.pop(13) > 1
    assert max(files.values()) <= 2
    back = readers.read_trips(spark, path)
    assert back.count() == 300000 and back.select("id").distinct().count() == 300000
    writers.write_partitioned(frame.limit(10), path, "pickup_day")
    assert readers.read_trips(spark, path).count() == 10


def test_report_sections(spark, tmp_path):
    sections = {"a": spark.range(3), "b": spark.sql("SELECT 'x' AS k, cast(null AS int) AS v")}
    writers.write_sections(sections, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "a")).count() == 3
    assert spark.read.json(str(tmp_path / "report" / "b")).first().k == "x"


def test_staging_folder_comes_from_the_session():
    class Session:
        """Settings of a cluster session."""

        def __init__(self, folder, master):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = type("Context", (), {"master": master})

    shared = staging.new_folder(Session("hdfs://shared/", "yarn"), "step")
    assert shared.startswith("hdfs://shared/step-")
    assert staging.new_folder(Session("hdfs://shared", "yarn"), "step") != shared
    with pytest.raises(ValueError):
        staging.new_folder(Session(None, "yarn"), "step")
    with pytest.raises(ValueError):
        staging.new_folder(Session(None, "local[2]"), "step")
    with pytest.raises(ValueError):
        staging.new_folder(Session("file:///tmp/shared", "yarn"), "step")
    assert staging.new_folder(Session("file:///shared", "local-cluster[2,1,1024]"), "step")


def test_materialised_reads_back_the_same(spark, tmp_path):
    frame = spark.range(5).withColumn("n", F.lit(None).cast("int"))
    back = staging.materialised(frame, str(tmp_path / "m"))
    assert back.dtypes == frame.dtypes and back.count() == 5


def test_arriving_files_are_prepared_once(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / name) for name in ("raw", "table", "state"))
    Path(folder).mkdir()

    def arrive(name, *lines):
        Path(folder, name).write_text("\n".join([HEADER, *lines]) + "\n")

    def run():
        raw = ingest.read_arriving_csv(spark, folder, schemas.TRIPS_ZONED_RAW)
        query = ingest.prepare_available(raw, schemas.ISO_MILLIS, 2024, path, checkpoint)
        assert query.awaitTermination(120)
        return sorted(
            tuple(r) for r in readers.read_trips(spark, path).select("pickup_day", "total_amount").collect()
        )

    arrive("one.csv", *LINES[:6])
    assert run() == [(13, 14.0), (13, 16.0), (31, 14.0)]
    arrive("two.csv", line("2024-11-02T08:00:00.000"), line("bad"))
    assert run() == [(2, 14.0), (13, 14.0), (13, 16.0), (31, 14.0)]
    assert run() == [(2, 14.0), (13, 14.0), (13, 16.0), (31, 14.0)]
    batch = prepare.prepared_trips(
        readers.read_zoned_csv(spark, folder), schemas.ISO_MILLIS, 2024
    )
    assert batch.count() == 4
    arrived = prepare.accounting_of(readers.read_rows(spark, path)).first()
    assert arrived == prepare.ingest_accounting(
        readers.read_zoned_csv(spark, folder), schemas.ISO_MILLIS, 2024
    ).first()
