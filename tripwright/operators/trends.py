"""Trends over the daily mart: moving averages, week-over-week growth, monthly rank.

The windows without a partition key run in one task. Their input is the daily mart,
at most one row per calendar date, so it does not grow with the number of trips.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions.exact import ratio
from tripwright.schemas import DEMAND_THRESHOLD_PCT, TRENDS

_BY_DATE = "ORDER BY trip_date"
_BY_DAY = "ORDER BY datediff(trip_date, DATE'1970-01-01')"


def _averages(calendar: bool) -> dict[str, Column]:
    week = f"({_BY_DATE} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    if calendar:
        week = f"({_BY_DAY} RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)"

    def mean(name: str, digits: int) -> Column:
        return F.expr(ratio(f"sum({name}) OVER {week}", f"count({name}) OVER {week}", digits))

    return {
        "trips_7d_moving_avg": mean("total_trips", 1),
        "revenue_7d_moving_avg": mean("total_revenue", 2),
    }


def _week_earlier(calendar: bool) -> dict[str, Column]:
    def earlier(name: str) -> Column:
        if calendar:
            return F.expr(f"max({name}) OVER ({_BY_DAY} RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING)")
        return F.expr(f"lag({name}, 7) OVER ({_BY_DATE})")

    return {
        "trips_same_day_last_week": earlier("total_trips"),
        "revenue_same_day_last_week": earlier("total_revenue"),
    }


def moving_averages(daily: DataFrame, calendar: bool = False) -> DataFrame:
    """Averages of the 7 rows ending at a day, or of the 7 days with ``calendar``;
    the two differ where dates are missing."""
    return daily.withColumns(_averages(calendar))


def last_week(daily: DataFrame, calendar: bool = False) -> DataFrame:
    """Values of 7 rows, or with ``calendar`` 7 days, earlier."""
    return daily.withColumns(_week_earlier(calendar))


def growth(df: DataFrame) -> DataFrame:
    """Percent growth over the columns of ``last_week``; NULL without an earlier value."""

    def pct(now: str, before: str, units: int) -> Column:
        change = f"CAST(({now} - {before}) * {units} AS DECIMAL(20,0)) * 100"
        return F.expr(ratio(change, f"{before} * {units}", 2))

    return df.withColumns(
        {
            "trips_wow_growth_pct": pct("total_trips", "trips_same_day_last_week", 1),
            "revenue_wow_growth_pct": pct("total_revenue", "revenue_same_day_last_week", 100),
        }
    )


def rank_in_month(daily: DataFrame) -> DataFrame:
    return daily.withColumn(
        "revenue_rank_in_month",
        F.expr(
            "rank() OVER (PARTITION BY trunc(trip_date, 'month')"
            " ORDER BY total_revenue DESC NULLS FIRST)"
        ),
    )


_DEMAND = f"""
    CASE WHEN trips_wow_growth_pct > {DEMAND_THRESHOLD_PCT} THEN 'growing'
         WHEN trips_wow_growth_pct < -{DEMAND_THRESHOLD_PCT} THEN 'declining'
         WHEN trips_wow_growth_pct IS NULL THEN 'insufficient_data'
         ELSE 'stable' END
"""


CARRIED_ROWS = 7


def trends_from(daily: DataFrame, earlier: DataFrame, first: date) -> DataFrame:
    """The trends of a month's first day and everything after it.

    ``daily`` has the rows from that day on and ``earlier`` some of those before it: the averages
    and growths of the first rows look back on the seven rows next to them, ranks on none.
    """
    carried = earlier.orderBy(F.desc("trip_date")).limit(CARRIED_ROWS)
    return revenue_trends(daily.unionByName(carried)).where(F.col("trip_date") >= F.lit(first))


def revenue_trends(daily: DataFrame, calendar: bool = False) -> DataFrame:
    """The trends mart. Growth is derived from lag columns computed once."""
    kept = [name for name in TRENDS.names if name in daily.columns]
    computed = {"day_of_week": "dayofweek(trip_date) - 1", "demand_trend": _DEMAND}
    return (
        daily.select(kept)
        .withColumns({**_averages(calendar), **_week_earlier(calendar)})
        .transform(growth)
        .transform(rank_in_month)
        .selectExpr([f"{computed.get(name, name)} AS {name}" for name in TRENDS.names])
    )
