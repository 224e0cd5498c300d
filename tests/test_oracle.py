"""Every registered query against DuckDB on the same files."""

from __future__ import annotations

import pytest
from oracle_check import connect, duck_side, spark_side, type_differences

from __spark_entry__ import entry, queries
from workbench import raw_files
from workbench.oracle import ORACLE
from workbench.registry import REGISTRY


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert REGISTRY.keys() == ORACLE.keys()
    assert REGISTRY.keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    frame = REGISTRY[name](spark, sf_dir)
    sql = ORACLE[name]
    assert spark_side(frame) == duck_side(duck, sql)
    assert type_differences(frame, duck, sql) == []


def test_entry_runs(spark, sf_dir):
    assert len(entry(spark).collect()) == 17


RAW = ("ingest_accounting", "ingest_csv_typed", "ingest_csv_gps")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_results_do_not_depend_on_session_settings(spark, sf_dir, duck, setting, zone):
    setting(
        spark__sql__session__timeZone=zone,
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    raw_files._written.clear()  # the raw files too are written under these settings
    for name in ("demand_topk", "flows_by_borough", "zone_imbalance", *RAW):
        assert spark_side(REGISTRY[name](spark, sf_dir)) == duck_side(duck, ORACLE[name])
