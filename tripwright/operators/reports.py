"""Ordered and top-k views of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_date(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.asc_nulls_last("trip_date"))


def by_trips(zones: DataFrame) -> DataFrame:
    """Busiest zone first, equally busy ones by their number."""
    return zones.orderBy(F.desc_nulls_first("total_trips"), F.asc_nulls_last("pickup_zone_id"))


def top_zones(zones: DataFrame, k: int = 10) -> DataFrame:
    return by_trips(zones).limit(k).select("pickup_zone_id", "total_trips", "total_revenue", "avg_fare")


def _latest(mart: DataFrame, k: int) -> DataFrame:
    return mart.orderBy(F.desc_nulls_first("trip_date")).limit(k)


def latest_days(daily: DataFrame, k: int = 10) -> DataFrame:
    return _latest(daily, k).select("trip_date", "total_trips", "total_revenue", "avg_fare")


def latest_trends(trends: DataFrame, k: int = 14) -> DataFrame:
    return _latest(trends, k).select(
        "trip_date",
        "day_of_week",
        "total_revenue",
        "revenue_7d_moving_avg",
        "revenue_wow_growth_pct",
        "demand_trend",
        "revenue_rank_in_month",
    )


def audit_report(audit: DataFrame) -> DataFrame:
    """Load runs, the latest first."""
    return audit.orderBy(F.desc_nulls_first("started_at")).select(
        "month", "status", "rows_loaded", "duration_secs", "started_at"
    )
