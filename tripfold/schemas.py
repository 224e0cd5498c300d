"""Explicit schemas of the raw inputs, as DDL text."""

# Header order of the three raw CSV files.
TRIPS_GPS_RAW = """
    VendorID INT,
    tpep_pickup_datetime STRING,
    tpep_dropoff_datetime STRING,
    passenger_count INT,
    trip_distance DOUBLE,
    pickup_longitude DOUBLE,
    pickup_latitude DOUBLE,
    RateCodeID INT,
    store_and_fwd_flag STRING,
    dropoff_longitude DOUBLE,
    dropoff_latitude DOUBLE,
    payment_type INT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    improvement_surcharge DOUBLE,
    total_amount DOUBLE
"""

TRIPS_ZONED_RAW = """
    VendorID INT,
    tpep_pickup_datetime STRING,
    tpep_dropoff_datetime STRING,
    passenger_count INT,
    trip_distance DOUBLE,
    RatecodeID INT,
    store_and_fwd_flag STRING,
    PULocationID INT,
    DOLocationID INT,
    payment_type INT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    improvement_surcharge DOUBLE,
    total_amount DOUBLE,
    congestion_surcharge DOUBLE,
    Airport_fee DOUBLE
"""

ZONES_RAW = """
    LocationID INT,
    Borough STRING,
    Zone STRING,
    service_zone STRING
"""

# Raw column -> canonical column. Names absent from a frame are ignored.
CANONICAL_NAMES = {
    "VendorID": "vendor_id",
    "RateCodeID": "rate_code_id",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "Airport_fee": "airport_fee",
    "LocationID": "location_id",
    "Borough": "borough",
    "Zone": "zone",
}

# The two raw timestamp layouts (a full-match pattern each).
SPACED_SECONDS = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ISO_MILLIS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$"

# Components of the surcharge total.
SURCHARGES = (
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)
