"""The physical plans the operators promise."""

from __future__ import annotations

import pytest
from plan_text import executed, planned, scans_of
from pyspark.sql import functions as F

from tripfold.functions import geo
from tripfold.operators import (
    congestion,
    demand,
    flows,
    imbalance,
    payments,
    periods,
    profile,
    revenue,
)
from tripfold.operators.window import window_trips, window_trips_by_calendar, window_trips_unpruned
from tripfold.params import AdaptiveSupport, TripWindow
from tripfold.plans.buckets import write_bucketed
from tripfold.plans.dimensions import unique_zones
from tripfold.reports import profile_report
from tripfold.sql import variants
from workbench import raw_files
from workbench.registry import REGISTRY

OPEN = TripWindow(days=None, hours=None)


@pytest.fixture(scope="module")
def by_day(spark, sf_dir):
    return raw_files.read_trips_by_day(spark, sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_query_pairs_rows_without_a_key(spark, sf_dir, name):
    plan = planned(REGISTRY[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_day_filter_prunes_partitions(by_day, setting):
    setting(spark__sql__maxMetadataStringLength="2000")
    plan = planned(window_trips(by_day, TripWindow()))
    assert "PartitionFilters: [isnotnull(pickup_day" in plan or "PartitionFilters: [pickup_day" in plan
    assert "GreaterThan(total_amount,0.0)" in plan


def test_day_of_timestamp_does_not(by_day):
    assert "PartitionFilters: []" in planned(window_trips_unpruned(by_day, TripWindow()))


def test_only_needed_columns_are_read(by_day):
    plan = planned(payments.payment_counts(by_day))
    assert "ReadSchema: struct<payment_type:int>" in plan


def test_small_dimension_is_broadcast_by_size(by_day, zones, setting):
    assert "BroadcastHashJoin" in planned(flows.pickup_zone_trips(by_day, zones))
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = executed(flows.pickup_zone_trips(by_day, zones))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_merge_strategy(by_day, zones):
    plan = planned(flows.pickup_zone_trips(by_day, zones, OPEN, "merge"))
    assert "SortMergeJoin" in plan


def test_hot_zone_is_split_in_a_merge_join(spark, zones, setting):
    """A zone holding most rows is cut into several tasks, and no row is lost."""
    setting(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions="16",
    )
    hot = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 25).otherwise(7).cast("int").alias("pu_location_id"),
        F.lit(12).alias("pickup_day"),
        F.lit(8).alias("pickup_hour"),
        *(F.lit(1.0).alias(name) for name in TripWindow().positive),
        F.col("id").alias("payload"),
    )
    joined = flows.pickup_zone_trips(hot, zones, strategy="merge")
    assert "skew=true" in executed(joined)
    assert joined.count() == 200000


def test_trips_meet_the_dimension_only_as_groups(by_day, zones):
    for frame in (
        flows.flow_rollup(by_day, zones),
        revenue.revenue_by_zone_bucket(by_day, zones),
        revenue.zone_revenue(by_day, zones),
    ):
        plan = planned(frame).splitlines()
        lowest_join = max(i for i, line in enumerate(plan) if "HashJoin" in line and "pu_location_id" in line)
        partial = max(i for i, line in enumerate(plan) if "partial_count" in line)
        assert lowest_join < partial


def test_top_k_is_a_heap(by_day, zones):
    for frame in (
        demand.demand_topk(by_day),
        revenue.revenue_topk(by_day, zones),
        flows.flows_by_borough(by_day, zones),
        imbalance.most_net_pickups(imbalance.zone_imbalance(by_day, zones)),
        periods.largest_increases(periods.od_period_change(by_day)),
    ):
        assert "TakeOrderedAndProject" in planned(frame)


def test_scans_of_the_facts(by_day, zones):
    def scans(frame):
        return scans_of(planned(frame), "trips-by-day")

    assert scans(periods.od_period_change(by_day)) == 1
    assert scans(periods.od_period_join(by_day)) == 2
    assert scans(imbalance.zone_imbalance(by_day, zones)) == 1
    assert scans(imbalance.zone_imbalance_outer_join(by_day, zones)) == 2
    assert scans(demand.demand_topk(by_day)) == 1
    assert scans(flows.flows_by_borough(by_day, zones)) == 1
    assert scans(revenue.revenue_by_zone_bucket(by_day, zones)) == 1


def test_a_profile_reads_the_trips_twice(by_day, zones, tmp_path):
    """Once for all counts, once for the samples; no section goes back to the trips."""
    names = profile_report(by_day, zones, str(tmp_path))
    assert len(names) == 11
    assert sum(scans_of(planned(frame), "trips-by-day") for frame in names.values()) == 0
    counts = planned(profile.tagged_counts(by_day, {"trip_distance": (0, 9), "total_amount": (0, 9)}))
    assert scans_of(counts, "trips-by-day") == 1 and "Expand" in counts
    assert counts.count("Exchange") == 1
    assert scans_of(planned(profile.extreme_samples(by_day)), "trips-by-day") == 1


def test_samples_are_held_not_sorted(by_day):
    """Below the exchange every task holds its rows; only what it sends is arranged by sample."""
    lines = planned(profile.extreme_samples(by_day)).splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert not any("Sort" in line or "Window" in line for line in lines[exchange:])
    assert any("MapInArrow" in line for line in lines[exchange:])


def test_a_year_reaches_the_scan_as_bounds(by_day, setting):
    setting(spark__sql__maxMetadataStringLength="2000")
    for form in (congestion.route_quality_by_hour, variants.route_quality_by_hour):
        plan = planned(form(by_day, year=1998))
        assert "GreaterThanOrEqual(pickup_ts,1998-01-01T00:00" in plan
        assert "LessThan(pickup_ts,1999-01-01T00:00" in plan


def test_percentiles_count_before_they_rank(by_day):
    plan = planned(congestion.duration_percentiles(by_day))
    assert "percentile" not in plan
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if " Window " in line)
    assert any("partial_count" in line for line in lines[window:])


def test_adaptive_total_is_taken_over_named_groups(by_day, zones):
    plan = planned(revenue.revenue_by_zone_bucket(by_day, zones, min_support=AdaptiveSupport()))
    lines = plan.splitlines()
    single = next(i for i, line in enumerate(lines) if "SinglePartition" in line)
    named = next(i for i, line in enumerate(lines) if "HashAggregate(keys=[pickup_borough" in line)
    assert single < named
    assert scans_of(plan, "trips-by-day") == 1


def test_native_distance_stays_in_the_jvm(by_day):
    native = planned(congestion.with_haversine(by_day, OPEN).select("haversine_km"))
    batch = planned(
        congestion.with_haversine(by_day, OPEN, geo.haversine_batch_km).select("haversine_km")
    )
    assert "Python" not in native and "ArrowEvalPython" in batch


def test_batch_distance_runs_after_the_filter(by_day):
    """Only windowed trips with coordinates cross over to Python."""
    plan = planned(congestion.with_haversine(by_day, form=geo.haversine_batch_km).select("haversine_km"))
    lines = plan.splitlines()
    python = next(i for i, line in enumerate(lines) if "ArrowEvalPython" in line)
    coordinates = max(i for i, line in enumerate(lines) if "Filter" in line and "pickup_latitude" in line)
    assert coordinates > python


def partitions_read(frame) -> int:
    """Partitions the file scan of an executed frame opened."""
    execution = frame._jdf.queryExecution()
    frame._jdf.collectToPython()
    found, left = [], [execution.executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        elif kind == "FileSourceScanExec" and node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return max(found)


def test_a_calendar_prunes_partitions_at_run_time(spark, sf_dir, by_day, setting):
    setting(spark__sql__maxMetadataStringLength="2000")
    days = spark.read.parquet(raw_files.calendar(spark, sf_dir))
    middle = F.col("part_of_month") == "middle"
    window = TripWindow()
    pruned = window_trips_by_calendar(by_day, days, middle, window)
    assert "dynamicpruning" in planned(pruned)
    assert partitions_read(pruned) == 3 < partitions_read(window_trips_unpruned(by_day, window))
    columns = sorted(pruned.columns)
    listed = window_trips(by_day, window).select(columns).collect()
    assert sorted(map(str, pruned.select(columns).collect())) == sorted(map(str, listed))


def test_tables_stored_by_zone_are_joined_where_they_lie(spark, sf_dir):
    name = raw_files.bucketed_trips(spark, sf_dir)
    trips, zones = spark.table(name), spark.table(f"{name}_zones")
    plan = planned(flows.pickup_zone_trips(trips, zones, OPEN, "merge", checked=True))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" in planned(flows.pickup_zone_trips(trips, zones.coalesce(3), OPEN, "merge", checked=True))
    with pytest.raises(Exception, match="zone id listed more than once"):
        unique_zones(zones.union(zones)).collect()


def test_windows_of_zone_reach_read_no_trips(spark, sf_dir):
    plan = planned(REGISTRY["reach_of_windows"](spark, sf_dir))
    assert "lineitem" not in plan and "zone-bitmaps" in plan


def test_trips_by_day_move_no_wider_rows_than_their_sources(spark, sf_dir):
    moved = raw_files.tables.made_trips(raw_files.tables.trip_sources(spark, sf_dir).hint("rebalance", "l_orderkey"))
    plan = moved._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = next(line for i, line in enumerate(plan) if "RebalancePartitions" in plan[i - 1] and i)
    assert "fare_amount" not in below and "l_extendedprice" in below


def test_a_hot_key_is_stored_by_several_tasks(spark, setting, tmp_path):
    setting(spark__sql__adaptive__advisoryPartitionSizeInBytes="20000")
    frame = spark.range(0, 40_000, 1, 8).selectExpr("1 AS zone", "uuid() AS text")
    stored = write_bucketed(frame, "hot_zone", str(tmp_path / "hot"), 4, "zone")
    assert len(stored.inputFiles()) > 1
    assert stored.count() == 40_000


def test_csv_copies_are_packed_in_small_files(spark, sf_dir):
    for path in (raw_files.zoned_csv(spark, sf_dir), raw_files.gps_csv(spark, sf_dir)):
        assert all(name.endswith(".csv.gz") for name in spark.read.text(path).inputFiles())
