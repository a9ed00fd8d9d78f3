"""Raw rows to cleaned trips. A lazy frame: marts inline it into their own plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripwright.schemas import STAGING

_KEPT = """
    tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND total_amount >= 0 AND trip_distance >= 0
    AND tpep_dropoff_datetime > tpep_pickup_datetime
"""

_COMPUTED = {
    "pickup_at": "tpep_pickup_datetime",
    "dropoff_at": "tpep_dropoff_datetime",
    "airport_fee": "coalesce(airport_fee, CAST(0 AS DECIMAL(10,2)))",
    "trip_duration_minutes": "CAST(CAST(CAST(tpep_dropoff_datetime - tpep_pickup_datetime"
    " AS INTERVAL SECOND) AS DECIMAL(18,6)) / 60 AS DECIMAL(27,9))",
}


def stage_trips(raw: DataFrame) -> DataFrame:
    """Keep trips that end after they start, with a non-negative amount and distance."""
    return raw.where(_KEPT).selectExpr(
        [f"{_COMPUTED.get(name, name)} AS {name}" for name in STAGING.names]
    )
