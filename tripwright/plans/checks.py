"""The checks each layer must pass."""

from __future__ import annotations

from tripwright.operators.quality import accepted_values, between, not_null, unique
from tripwright.schemas import DEMAND_LABELS

# Columns, ranges and labels of the declared checks.
STAGING_CHECKS = [
    not_null("pickup_at"),
    not_null("dropoff_at"),
    not_null("total_amount"),
    between("total_amount", 0, 1000),
    not_null("trip_distance"),
    between("trip_distance", 0, 500),
    between("passenger_count", 0, 9),
    not_null("pu_location_id"),
    not_null("do_location_id"),
    accepted_values("payment_type", range(7)),
    not_null("trip_duration_minutes"),
    between("trip_duration_minutes", 0, 600, strictly=True),
]

DAILY_CHECKS = [
    not_null("trip_date"),
    unique("trip_date"),
    not_null("total_trips"),
    not_null("total_revenue"),
    not_null("avg_fare"),
]

ZONE_CHECKS = [
    not_null("pickup_zone_id"),
    unique("pickup_zone_id"),
    not_null("total_trips"),
    not_null("total_revenue"),
]

TRENDS_CHECKS = [
    not_null("trip_date"),
    unique("trip_date"),
    not_null("trips_7d_moving_avg"),
    not_null("revenue_7d_moving_avg"),
    not_null("revenue_rank_in_month"),
    not_null("demand_trend"),
    accepted_values("demand_trend", DEMAND_LABELS),
]
