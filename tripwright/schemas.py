"""Layer schemas and the fixed values every other module agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

INT = T.IntegerType()
BIGINT = T.LongType()
DOUBLE = T.DoubleType()
TEXT = T.StringType()
DATE = T.DateType()
TIMESTAMP = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)

# ---------------------------------------------------------------------------
# Names, formats and types that input files and existing readers
# of the tables depend on.

SOURCE_NAME = "nyc_taxi_yellow"
FILE_PREFIX = "yellow_tripdata_"
FILE_SUFFIX = ".parquet"
FIRST_MONTH = "2024-01"

# header in the monthly file, column name, column type
SOURCE_COLUMNS = [
    ("VendorID", "vendor_id", INT),
    ("tpep_pickup_datetime", "tpep_pickup_datetime", TIMESTAMP),
    ("tpep_dropoff_datetime", "tpep_dropoff_datetime", TIMESTAMP),
    ("passenger_count", "passenger_count", INT),
    ("trip_distance", "trip_distance", DOUBLE),
    ("RatecodeID", "ratecode_id", INT),
    ("store_and_fwd_flag", "store_and_fwd_flag", TEXT),
    ("PULocationID", "pu_location_id", INT),
    ("DOLocationID", "do_location_id", INT),
    ("payment_type", "payment_type", INT),
    ("fare_amount", "fare_amount", MONEY),
    ("extra", "extra", MONEY),
    ("mta_tax", "mta_tax", MONEY),
    ("tip_amount", "tip_amount", MONEY),
    ("tolls_amount", "tolls_amount", MONEY),
    ("improvement_surcharge", "improvement_surcharge", MONEY),
    ("total_amount", "total_amount", MONEY),
    ("congestion_surcharge", "congestion_surcharge", MONEY),
    ("Airport_fee", "airport_fee", MONEY),
]

DEMAND_LABELS = ("growing", "stable", "declining", "insufficient_data")
DEMAND_THRESHOLD_PCT = 10
LOOKBACK_DAYS = 2
# ---------------------------------------------------------------------------

HEADER_TO_NAME = {header: name for header, name, _ in SOURCE_COLUMNS}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


RAW = _struct(
    *[(name, dtype) for _, name, dtype in SOURCE_COLUMNS],
    ("source_file", TEXT),
    ("loaded_at", TIMESTAMP),
)

STAGING = _struct(
    ("vendor_id", INT),
    ("pu_location_id", INT),
    ("do_location_id", INT),
    ("pickup_at", TIMESTAMP),
    ("dropoff_at", TIMESTAMP),
    ("passenger_count", INT),
    ("trip_distance", DOUBLE),
    ("ratecode_id", INT),
    ("store_and_fwd_flag", TEXT),
    ("payment_type", INT),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("improvement_surcharge", MONEY),
    ("congestion_surcharge", MONEY),
    ("airport_fee", MONEY),
    ("total_amount", MONEY),
    ("trip_duration_minutes", T.DecimalType(27, 9)),
    ("source_file", TEXT),
    ("loaded_at", TIMESTAMP),
)

# Mart measures: whole numbers are BIGINT, rounded ones DECIMAL(18, digits).
TENTHS = T.DecimalType(18, 1)
HUNDREDTHS = T.DecimalType(18, 2)

DAILY = _struct(
    ("trip_date", DATE),
    ("total_trips", BIGINT),
    ("total_passengers", BIGINT),
    ("total_distance_miles", HUNDREDTHS),
    ("avg_distance_miles", HUNDREDTHS),
    ("avg_duration_minutes", TENTHS),
    ("total_revenue", HUNDREDTHS),
    ("avg_fare", HUNDREDTHS),
    ("total_tips", HUNDREDTHS),
    ("avg_tip", HUNDREDTHS),
    ("tip_pct_of_revenue", HUNDREDTHS),
)

ZONE = _struct(
    ("pickup_zone_id", INT),
    ("total_trips", BIGINT),
    ("most_common_dropoff_zone", INT),
    ("avg_distance_miles", HUNDREDTHS),
    ("total_revenue", HUNDREDTHS),
    ("avg_fare", HUNDREDTHS),
    ("avg_tip", HUNDREDTHS),
    ("avg_duration_minutes", TENTHS),
)

TRENDS = _struct(
    ("trip_date", DATE),
    ("day_of_week", INT),
    ("total_trips", BIGINT),
    ("total_revenue", HUNDREDTHS),
    ("avg_fare", HUNDREDTHS),
    ("avg_tip", HUNDREDTHS),
    ("tip_pct_of_revenue", HUNDREDTHS),
    ("trips_7d_moving_avg", TENTHS),
    ("revenue_7d_moving_avg", HUNDREDTHS),
    ("trips_same_day_last_week", BIGINT),
    ("revenue_same_day_last_week", HUNDREDTHS),
    ("trips_wow_growth_pct", HUNDREDTHS),
    ("revenue_wow_growth_pct", HUNDREDTHS),
    ("revenue_rank_in_month", INT),
    ("demand_trend", TEXT),
)

WATERMARK = _struct(("source_name", TEXT), ("last_loaded_month", DATE))

AUDIT = _struct(
    ("source_name", TEXT),
    ("month", TEXT),
    ("source_file", TEXT),
    ("status", TEXT),
    ("rows_loaded", BIGINT),
    ("error_message", TEXT),
    ("started_at", TIMESTAMP),
    ("finished_at", TIMESTAMP),
    ("duration_secs", MONEY),
)

# What a raw version knows of each file, and months the stream has set aside.
FILE_FACTS = _struct(
    ("source_file", TEXT),
    ("rows", BIGINT),
    ("first_pickup", TIMESTAMP),
    ("last_pickup", TIMESTAMP),
    ("loaded_at", TIMESTAMP),
)

QUARANTINE = _struct(
    ("source_name", TEXT),
    ("month", TEXT),
    ("source_file", TEXT),
    ("delivery", TEXT),
    ("error_message", TEXT),
    ("healed", T.BooleanType()),
    ("noted_at", TIMESTAMP),
)
