from decimal import Decimal

from frames import daily

from tripwright.operators.reports import by_date
from tripwright.operators.trends import revenue_trends
from tripwright.schemas import TRENDS


def trends(spark, *rows, **options):
    return by_date(revenue_trends(daily(spark, *rows), **options)).collect()


def january(trips, revenue=None):
    return [
        (f"2024-01-{i + 1:02d}", n, (revenue or [100] * len(trips))[i]) for i, n in enumerate(trips)
    ]


def test_columns(spark):
    mart = revenue_trends(daily(spark, *january([1, 2])))
    assert mart.columns == TRENDS.names
    assert [f.dataType for f in mart.schema] == [f.dataType for f in TRENDS]


def test_moving_averages_start_with_a_short_frame(spark):
    rows = trends(spark, *january([1, 2, 4, 8, 16, 32, 64, 128], [1, 2, 4, 8, 16, 32, 64, 128.01]))
    assert [row.trips_7d_moving_avg for row in rows] == [
        Decimal(v) for v in ("1.0", "1.5", "2.3", "3.8", "6.2", "10.5", "18.1", "36.3")
    ]
    assert rows[2].revenue_7d_moving_avg == Decimal("2.33")
    assert rows[7].revenue_7d_moving_avg == Decimal("36.29")


def test_growth_needs_seven_earlier_rows(spark):
    rows = trends(spark, *january([10] * 8, [5] * 7 + [4]))
    assert {row.trips_wow_growth_pct for row in rows[:7]} == {None}
    assert {row.demand_trend for row in rows[:7]} == {"insufficient_data"}
    assert rows[7].trips_same_day_last_week == 10
    assert rows[7].revenue_same_day_last_week == Decimal("5.00")
    assert rows[7].revenue_wow_growth_pct == Decimal("-20.00")


def test_demand_boundaries(spark):
    base = [10000] * 7
    # exactly +-10 % is stable, so is what rounds to it; 0.01 more is not
    for now, label in [
        (11000, "stable"), (9000, "stable"), (11001, "growing"), (8999, "declining"), (10000, "stable"),
    ]:
        assert trends(spark, *january([*base, now]))[7].demand_trend == label, now
    tenth = [1_000_000] * 7
    assert trends(spark, *january([*tenth, 1_100_040]))[7].demand_trend == "stable"  # 10.00 rounded
    assert trends(spark, *january([*tenth, 1_100_050]))[7].demand_trend == "growing"  # 10.01
    assert trends(spark, *january([*tenth, 899_950]))[7].trips_wow_growth_pct == Decimal("-10.01")


def test_growth_from_zero_is_unknown(spark):
    rows = trends(spark, *january([5] * 8, [0] * 7 + [10]))
    assert rows[7].revenue_wow_growth_pct is None
    assert rows[7].trips_wow_growth_pct == Decimal("0.00")


def test_rank_shares_and_skips(spark):
    rows = trends(
        spark,
        ("2024-01-30", 1, 50), ("2024-01-31", 1, 70), ("2024-01-29", 1, 70), ("2024-01-28", 1, 60),
        ("2024-02-01", 1, 10),
    )
    ranks = {row.trip_date.isoformat(): row.revenue_rank_in_month for row in rows}
    assert ranks == {
        "2024-01-28": 3, "2024-01-29": 1, "2024-01-30": 4, "2024-01-31": 1, "2024-02-01": 1,
    }


def test_unknown_revenue_ranks_first(spark):
    rows = trends(spark, ("2024-01-01", 1, None), ("2024-01-02", 1, 5))
    assert [row.revenue_rank_in_month for row in rows] == [1, 2]


def test_day_of_week(spark):
    rows = trends(spark, ("2024-01-06", 1, 1), ("2024-01-07", 1, 1))
    assert [row.day_of_week for row in rows] == [6, 0]


def test_gaps_count_rows_unless_asked_for_days(spark):
    days = [("2024-01-01", 1, 1), ("2024-01-02", 2, 2), ("2024-01-20", 3, 3), ("2024-01-27", 6, 6)]
    by_row = trends(spark, *days)
    assert [row.trips_7d_moving_avg for row in by_row][2:] == [Decimal("2.0"), Decimal("3.0")]
    assert {row.trips_wow_growth_pct for row in by_row} == {None}
    by_day = trends(spark, *days, calendar=True)
    assert [row.trips_7d_moving_avg for row in by_day][2:] == [Decimal("3.0"), Decimal("6.0")]
    assert by_day[3].trips_wow_growth_pct == Decimal("100.00")
