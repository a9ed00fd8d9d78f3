"""Hand-made frames."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from tripwright.schemas import DAILY, RAW, STAGING

CAMEL_ROW = {
    "VendorID": 2,
    "tpep_pickup_datetime": "2024-01-09 17:05:00",
    "tpep_dropoff_datetime": "2024-01-09 17:31:00",
    "passenger_count": 4,
    "trip_distance": 6.25,
    "RatecodeID": 5,
    "store_and_fwd_flag": "Y",
    "PULocationID": 48,
    "DOLocationID": 231,
    "payment_type": 2,
    "fare_amount": 27.5,
    "extra": 1.0,
    "mta_tax": 0.25,
    "tip_amount": 0.75,
    "tolls_amount": 6.94,
    "improvement_surcharge": 1.0,
    "total_amount": 39.44,
    "congestion_surcharge": 2.0,
    "Airport_fee": 1.75,
}


def frame(spark, *rows: dict):
    return spark.createDataFrame([tuple(row.values()) for row in rows], list(rows[0]))


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def _fill(schema, values: dict) -> tuple:
    unknown = set(values) - set(schema.names)
    assert not unknown, unknown
    return tuple(values.get(name) for name in schema.names)


def raw(spark, *rows: dict):
    """Raw rows; a row needs only what the test is about."""
    base = {
        "tpep_pickup_datetime": at("2024-01-01 08:00"),
        "tpep_dropoff_datetime": at("2024-01-01 08:20"),
        "trip_distance": 1.0,
        "total_amount": 10,
        "source_file": "yellow_tripdata_2024-01.parquet",
        "loaded_at": at("2024-02-01 00:00"),
    }
    filled = []
    for row in rows:
        row = {**base, **row}
        row["total_amount"] = money(row["total_amount"])
        filled.append(_fill(RAW, row))
    return spark.createDataFrame(filled, RAW)


def staged(spark, *rows: dict):
    """Staged trips from {day, minutes, total_amount, ...}."""
    filled = []
    for row in rows:
        row = {"trip_distance": 1.0, "total_amount": 10, "tip_amount": 1, **row}
        pickup = row.pop("pickup_at", None) or at(row.pop("day", "2024-01-01") + " 08:00")
        seconds = row.pop("seconds", None)
        minutes = row.pop("minutes", 10)
        row["pickup_at"] = pickup
        row["dropoff_at"] = pickup + timedelta(seconds=60 * minutes if seconds is None else seconds)
        row["total_amount"], row["tip_amount"] = money(row["total_amount"]), money(row["tip_amount"])
        filled.append(_fill(STAGING, row))
    return spark.createDataFrame(filled, STAGING)


def daily(spark, *rows: tuple):
    """Daily rows from (date, trips, revenue)."""
    filled = [
        _fill(
            DAILY,
            {
                "trip_date": datetime.fromisoformat(day).date(),
                "total_trips": trips,
                "total_revenue": money(revenue),
            },
        )
        for day, trips, revenue in rows
    ]
    return spark.createDataFrame(filled, DAILY)
