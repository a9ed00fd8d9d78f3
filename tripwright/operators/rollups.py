"""Daily and pickup-zone rollups over staged trips.

Both are ``groupBy().agg()`` over sums that combine before the shuffle, so a day
or a zone holding a large share of all trips costs one partial row per task. The
measures are whole-number sums (see ``functions.exact``); distances and durations
are split into a whole part and a sub-unit part so neither can overflow. A distance
counts to the millionth of a mile; one of 1e12 miles or more, NaN or infinity is none
and left out of the distance measures (the declared range check counts such rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions.exact import cents, from_cents, ratio, rounded
from tripwright.schemas import DAILY, ZONE

_RIDE = "(dropoff_at - pickup_at)"
_RIDE_SECONDS = f"CAST(CAST({_RIDE} AS INTERVAL SECOND) AS BIGINT)"
# No trip is that long, and sums of shorter ones fit. Spark orders NaN above every number, so
# this is false for NaN and infinity too.
_FINITE = "trip_distance < 1e12D"

TRIP_SUMS = {
    "trips": "count(1)",
    "passengers": "sum(passenger_count)",
    "whole_miles": f"sum(if({_FINITE}, floor(trip_distance), NULL))",
    "micro_miles": f"sum(if({_FINITE},"
    " CAST(rint((trip_distance - floor(trip_distance)) * 1e6) AS BIGINT), NULL))",
    "unbounded_distances": f"count_if(NOT {_FINITE})",
    "ride_seconds": f"sum({_RIDE_SECONDS})",
    "ride_remainder": f"sum({_RIDE} - INTERVAL '1' SECOND * {_RIDE_SECONDS})",
    "revenue_cents": f"sum({cents('total_amount')})",
    "tip_cents": f"sum({cents('tip_amount')})",
    "tips": "count(tip_amount)",
}

_MILES = (
    "CAST(CAST(whole_miles AS DECIMAL(18,0))"
    " + CAST(micro_miles AS DECIMAL(20,0)) * 0.000001BD AS DECIMAL(24,6))"
)
_SECONDS = (
    "(CAST(ride_seconds AS DECIMAL(18,0))"
    " + CAST(CAST(ride_remainder AS INTERVAL SECOND) AS DECIMAL(18,6)))"
)
_REVENUE, _TIPS = from_cents("revenue_cents"), from_cents("tip_cents")

MEASURES = {
    "total_trips": "trips",
    "total_passengers": "passengers",
    "total_distance_miles": rounded(_MILES, 2),
    "avg_distance_miles": ratio(_MILES, "trips - unbounded_distances", 2),
    "avg_duration_minutes": ratio(_SECONDS, "trips * 60", 1),
    "total_revenue": rounded(_REVENUE, 2),
    "avg_fare": ratio(_REVENUE, "trips", 2),
    "total_tips": rounded(_TIPS, 2),
    "avg_tip": ratio(_TIPS, "tips", 2),
    "tip_pct_of_revenue": ratio("CAST(tip_cents AS DECIMAL(18,0)) * 100", "revenue_cents", 2),
}


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def _trip_sums() -> list[Column]:
    return [F.expr(column) for column in _named(TRIP_SUMS)]


def daily_mart(staged: DataFrame) -> DataFrame:
    """One row per pickup date."""
    columns = {"trip_date": "trip_date", **MEASURES}
    return (
        staged.groupBy(F.to_date("pickup_at").alias("trip_date"))
        .agg(*_trip_sums())
        .selectExpr(_named({name: columns[name] for name in DAILY.names}))
    )


def _commonest(value: str, count: str) -> Column:
    """(-count, value) of the commonest value, the smallest of tied ones; NULLs do not count."""
    return F.expr(
        f"min(if({value} IS NULL, NULL, struct(-{count} AS minus_count, {value} AS value))) AS best"
    )


def pair_sums(staged: DataFrame, *keys: str) -> DataFrame:
    """Additive sums of each pair of zones (and other keys), from which sums of sums can be made."""
    return staged.groupBy(*keys, "pu_location_id", "do_location_id").agg(*_trip_sums())


def merged_sums(sums: DataFrame) -> DataFrame:
    """Sums over the pairs of zones of several ``pair_sums``."""
    return sums.groupBy("pu_location_id", "do_location_id").agg(
        *[F.expr(f"sum({name}) AS {name}") for name in TRIP_SUMS]
    )


def zones_of_pairs(pairs: DataFrame) -> DataFrame:
    """The zone mart from one row of sums for each pair of zones."""
    columns = {
        "pickup_zone_id": "pu_location_id",
        "most_common_dropoff_zone": "best.value",
        **MEASURES,
    }
    return (
        pairs.groupBy("pu_location_id")
        .agg(
            _commonest("do_location_id", "trips"),
            *[F.expr(f"sum({name}) AS {name}") for name in TRIP_SUMS],
        )
        .selectExpr(_named({name: columns[name] for name in ZONE.names}))
    )


def zone_mart(staged: DataFrame) -> DataFrame:
    """One row per pickup zone over its whole history; a NULL zone is a zone.

    The first step groups by (zone, dropoff zone), so the mode needs no per-group
    value map: its counts are ordinary sums, and the second step reads only one row
    per pair.
    """
    return zones_of_pairs(pair_sums(staged))


def mode_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent ``value`` of each ``key`` and how often it occurs."""
    return (
        df.groupBy(key, value)
        .agg(F.expr("count(1) AS n"))
        .groupBy(key)
        .agg(_commonest(value, "n"))
        .selectExpr(key, f"best.value AS {value}", "-best.minus_count AS occurrences")
    )


def file_summary(raw: DataFrame) -> DataFrame:
    """Rows and pickup range of every loaded file."""
    return raw.groupBy("source_file").agg(
        F.expr("count(1) AS rows"),
        F.expr("min(tpep_pickup_datetime) AS first_pickup"),
        F.expr("max(tpep_pickup_datetime) AS last_pickup"),
    )
