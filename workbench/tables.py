"""The star-schema tables as the trips and zones the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripfold.sources.prepare import with_calendar, with_measures

# Declared, so opening a table reads no file footers.
SCHEMAS = {
    "lineitem": """
        l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ
    """,
    "orders": """
        o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING
    """,
    "customer": """
        c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING
    """,
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": """
        event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
        props STRING
    """,
}

# A trip per line item: ends from customer and supplier, money from the item, times made from
# the order date and the keys, with nulls, zeros, negative fares and zone ids that no zone has
# on purpose.
TRIP_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "cast(l_suppkey % 2 + 1 AS int) AS vendor_id",
    "timestampadd(SECOND, cast((l_orderkey * 7919 + l_linenumber * 613) % 86400 AS int),"
    " o_orderdate) AS pickup_ts",
    "timestampadd(SECOND, datediff(l_shipdate, o_orderdate) * 6, pickup_ts) AS dropoff_ts",
    "nullif(l_linenumber, 7) AS passenger_count",
    "l_quantity / 4 AS trip_distance",
    "CASE WHEN l_orderkey % 31 = 0 THEN NULL WHEN l_orderkey % 37 = 0 THEN c_nationkey + 100"
    " ELSE c_nationkey END AS pu_location_id",
    "if(l_orderkey % 41 = 0, NULL, s_nationkey + 5) AS do_location_id",
    "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS payment_type",
    "if(l_orderkey % 89 = 0, -l_extendedprice, l_extendedprice) AS fare_amount",
    "if(l_returnflag = 'A', l_extendedprice * l_discount, 0e0) AS tip_amount",
    "l_extendedprice * l_tax AS extra",
    "if(l_linenumber = 5, NULL, 0.5e0) AS mta_tax",
    "if(l_linenumber % 3 = 0, 6.55e0, 0e0) AS tolls_amount",
    "if(l_suppkey % 5 = 0, NULL, 0.3e0) AS improvement_surcharge",
    "if(l_suppkey % 4 = 0, NULL, 2.5e0) AS congestion_surcharge",
    "CASE WHEN l_linestatus = 'F' THEN NULL WHEN l_linenumber = 6 THEN 1.75e0 ELSE 0e0 END"
    " AS airport_fee",
    "l_extendedprice * (1 + l_tax) AS total_amount",
    "if(l_orderkey % 50 = 0, 0e0, 40.6e0 + c_nationkey % 5 * 0.05e0 + l_linenumber * 0.001e0)"
    " AS pickup_latitude",
    "-74e0 + floor(c_nationkey / 5) * 0.04e0 AS pickup_longitude",
    "40.6e0 + s_nationkey % 5 * 0.05e0 AS dropoff_latitude",
    "-74e0 + floor(s_nationkey / 5) * 0.04e0 AS dropoff_longitude",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS location_id",
        "r_name AS borough",
        "n_name AS zone",
        "if(n_nationkey % 2 = 0, 'even', 'odd') AS service_zone",
    )


# What the trips are made from; narrower than they are.
SOURCES = (
    *("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    *("l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate", "c_nationkey", "s_nationkey"),
)


def trip_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns trips are made from, a row per line item.

    The order side is joined with its customers first, so line items, the big side, are
    shuffled once, by order. All joins are left to Spark's size check.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return (
        lineitem.join(placed, lineitem.l_orderkey == placed.o_orderkey)
        .join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .select(*SOURCES)
    )


def made_trips(sources: DataFrame) -> DataFrame:
    return with_measures(with_calendar(sources.selectExpr(*TRIP_COLUMNS)))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item."""
    return made_trips(trip_sources(spark, sf_dir))
