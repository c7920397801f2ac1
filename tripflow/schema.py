"""Declared schemas, column lists and other fixed names of the trip tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: bronze columns in order; the second list is what validation requires ---
BRONZE = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)

REQUIRED_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "total_amount",
]

# --- fixed values: imputation defaults ---
NULL_DEFAULTS = {
    "passenger_count": 1,
    "RatecodeID": 1,
    "congestion_surcharge": 0,
    "Airport_fee": 0,
    "store_and_fwd_flag": "N",
}

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
TARGET = "trip_duration_min"
SILVER_COLUMNS = BRONZE.fieldNames() + [TARGET]

# --- fixed values: columns that leak the target or carry no signal ---
LEAKAGE_COLUMNS = [
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "extra",
    "mta_tax",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
    "fare_per_mile",
    "surcharge_ratio",
    "toll_ratio",
    "non_fare_amount",
]
NON_PREDICTIVE_COLUMNS = ["tpep_pickup_datetime", "route_id"]

# --- fixed values: encoding and scaling plan of the model table ---
BINARY_COLUMNS = ["store_and_fwd_flag"]
ONEHOT_COLUMNS = ["VendorID", "RatecodeID", "payment_type"]
TARGET_ENCODED_COLUMNS = ["DOLocationID", "PULocationID"]
SCALED_COLUMNS = [
    "trip_distance",
    "log_trip_distance",
    "sqrt_trip_distance",
    "passenger_count",
    "pickup_zone_trip_count",
    "dropoff_zone_trip_count",
    "route_trip_count",
]

# --- fixed values: the model's feature order ---
FEATURES = [
    "passenger_count",
    "trip_distance",
    "store_and_fwd_flag",
    "pickup_hour",
    "pickup_day_of_month",
    "pickup_week_of_year",
    "pickup_month",
    "pickup_year",
    "pickup_day_of_week",
    "is_weekend",
    "is_peak_hour",
    "is_night",
    "is_rush_hour",
    "sin_hour",
    "cos_hour",
    "sin_day_of_week",
    "cos_day_of_week",
    "is_short_trip",
    "is_long_trip",
    "log_trip_distance",
    "sqrt_trip_distance",
    "is_same_zone",
    "pickup_zone_trip_count",
    "dropoff_zone_trip_count",
    "route_trip_count",
    "has_tolls",
    "has_airport_fee",
    "has_congestion_fee",
    "VendorID_2",
    "VendorID_6",
    "RatecodeID_2",
    "RatecodeID_3",
    "RatecodeID_4",
    "RatecodeID_5",
    "RatecodeID_6",
    "payment_type_1",
    "payment_type_2",
    "payment_type_3",
    "payment_type_4",
    "DOLocationID_encoded",
    "PULocationID_encoded",
]

# --- fixed values: scoring request fields, (name, type, default); None = required ---
REQUEST_FIELDS = [
    ("pickup_datetime", "timestamp_ntz", None),
    ("PULocationID", "int", None),
    ("DOLocationID", "int", None),
    ("trip_distance", "double", None),
    ("passenger_count", "int", 1),
    ("VendorID", "int", 1),
    ("RatecodeID", "int", 1),
    ("payment_type", "int", 1),
    ("store_and_fwd_flag", "string", "N"),
    ("tolls_amount", "double", 0.0),
    ("Airport_fee", "double", 0.0),
    ("congestion_surcharge", "double", 0.0),
]
# --- fixed values: request bounds, (lowest, highest), both inclusive ---
REQUEST_BOUNDS = {
    "trip_distance": (0, None),
    "passenger_count": (0, 9),
    "tolls_amount": (0, None),
    "Airport_fee": (0, None),
    "congestion_surcharge": (0, None),
}

STAGE_RUNS = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("created_at_utc", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("data_rows", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
        T.StructField("artifacts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

# What the ledger of a refresh knows of a month beyond that: its content, its files, and how often it was committed.
REFRESH_LEDGER = T.StructType(
    [
        *LEDGER,
        T.StructField("digest", T.StringType()),
        T.StructField("files", T.StringType()),
        T.StructField("version", T.IntegerType()),
    ]
)
