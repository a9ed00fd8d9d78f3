from test_ingest import deliver

from tripwright.operators.rollups import daily_mart, zone_mart
from tripwright.operators.trends import revenue_trends
from tripwright.plans import build
from tripwright.plans.ingest import load_months
from tripwright.sources.tables import Store


def test_marts_follow_raw(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), Store(str(tmp_path / "store"))
    deliver(spark, landing, "2024-01", *range(1, 29))
    load_months(spark, store, landing, ["2024-01"])
    build.build_marts(spark, store)
    deliver(spark, landing, "2024-02", *range(5, 15))
    load_months(spark, store, landing, ["2024-02"])
    build.build_marts(spark, store)
    trips = build.staging(spark, store)
    assert sorted(build.daily(spark, store).collect()) == sorted(daily_mart(trips).collect())
    assert build.zones(spark, store).collect() == zone_mart(trips).collect()
    want = sorted(map(str, revenue_trends(daily_mart(trips)).collect()))
    assert sorted(map(str, build.trends(spark, store).collect())) == want
    checks = build.check_store(spark, store).collect()
    assert len(checks) == 28
    assert {row.failures for row in checks} == {0}


def test_late_old_trips_reach_zones_but_not_days(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), Store(str(tmp_path / "store"))
    deliver(spark, landing, "2024-02", 1, 2, 3)
    load_months(spark, store, landing, ["2024-02"])
    build.build_marts(spark, store)
    deliver(spark, landing, "2024-01", 50)
    load_months(spark, store, landing, ["2024-01"])
    build.build_marts(spark, store)
    assert build.daily(spark, store).count() == 3
    assert build.zones(spark, store).first().total_trips == 4
    build.build_marts(spark, store, full_refresh=True)
    assert build.daily(spark, store).count() == 4
