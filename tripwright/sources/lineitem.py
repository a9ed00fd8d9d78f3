"""Trip rows derived from the order-line table, one trip per line.

All arithmetic is whole-number or exact decimal, so any engine gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwright.schemas import FILE_PREFIX, FILE_SUFFIX, HEADER_TO_NAME, RAW


def _money(whole_cents: str) -> str:
    return f"CAST({whole_cents} AS DECIMAL(6,0)) * 0.01BD"


_START = "(l_orderkey * 7 + l_linenumber * 131) % 1440"


def _minutes_after_shipping(minutes: str) -> str:
    return f"timestampadd(MINUTE, CAST({minutes} AS INT), l_shipdate)"


_PICKUP = _minutes_after_shipping(_START)
_DROPOFF = _minutes_after_shipping(f"{_START} + CAST(l_quantity AS INT) - 3")

COLUMNS = {
    "vendor_id": "l_linenumber % 2 + 1",
    "tpep_pickup_datetime": _PICKUP,
    "tpep_dropoff_datetime": f"if((l_orderkey + l_linenumber) % 500 = 0, NULL, {_DROPOFF})",
    "passenger_count": "if(l_linenumber = 7, NULL, l_linenumber % 6 + 1)",
    "trip_distance": "l_quantity / 4",
    "ratecode_id": "l_partkey % 6 + 1",
    "store_and_fwd_flag": "if(l_linestatus = 'O', 'Y', 'N')",
    "pu_location_id": "l_suppkey % 263 + 1",
    "do_location_id": "if(l_orderkey % 400 = 1, NULL, l_partkey % 263 + 1)",
    "payment_type": "l_partkey % 7",
    "fare_amount": _money("c % 9000"),
    "extra": "0.50BD",
    "mta_tax": "0.50BD",
    "tip_amount": _money("c % 700"),
    "tolls_amount": "0.00BD",
    "improvement_surcharge": "0.30BD",
    "total_amount": _money(
        "if(l_returnflag = 'R' AND l_linenumber = 1, -(c % 9000) - 1, c % 9000 + c % 700)"
    ),
    "congestion_surcharge": "2.50BD",
    "airport_fee": "if(l_linenumber % 2 = 0, NULL, 1.25BD)",
    "source_file": f"concat('{FILE_PREFIX}', date_format({_PICKUP}, 'yyyy-MM'), '{FILE_SUFFIX}')",
    "loaded_at": "TIMESTAMP_NTZ'2024-02-01 00:00:00'",
}


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lazy raw-layer frame over ``lineitem``; unused columns are never read."""
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .selectExpr("*", "CAST(round(l_extendedprice * 100) AS BIGINT) AS c")
        .selectExpr(
            [
                f"CAST({COLUMNS[field.name]} AS {field.dataType.simpleString()}) AS {field.name}"
                for field in RAW
            ]
        )
    )


def as_delivered(trips: DataFrame) -> DataFrame:
    """The same trips under the headers and loose types of a monthly file."""
    loose = {"passenger_count": "double", "RatecodeID": "double", "PULocationID": "bigint"}
    return trips.selectExpr(
        *[
            f"CAST({name} AS {loose[header]}) AS {header}" if header in loose else f"{name} AS {header}"
            for header, name in HEADER_TO_NAME.items()
        ],
        "source_file",
    )
