"""Versioned tables: whole or unchanged, whatever fails."""

import glob
from datetime import date

import pytest
from frames import daily
from pyspark.sql import functions as F
from test_ingest import deliver, totals

from tripwright.operators.trends import revenue_trends
from tripwright.operators.upsert import monthly, newest_date, refresh_daily, write_months
from tripwright.plans import build, ingest, per_file
from tripwright.schemas import DAILY, RAW
from tripwright.sources import tables
from tripwright.sources.tables import Store, audit_row, append_audit, raw_table, read_audit, read_raw
from tripwright.sources.versions import CommitConflict, NotBuilt, Part, SchemaChanged, create_file

DAYS = [("2024-01-30", 3, 30), ("2024-02-01", 5, 50)]


def put(spark, path, *rows):
    table = monthly(path)
    return table, table.put(spark, DAILY, write_months(daily(spark, *rows), table, {}))


def trips_of(df):
    return {str(r.trip_date): r.total_trips for r in df.collect()}


def test_a_version_is_pinned(spark, tmp_path):
    table, first = put(spark, str(tmp_path), *DAYS)
    before = table.read(spark, DAILY, first)
    _, second = put(spark, str(tmp_path), ("2024-02-01", 9, 9))
    assert trips_of(before) == {"2024-01-30": 3, "2024-02-01": 5}
    assert trips_of(table.read(spark, DAILY, second)) == {"2024-01-30": 3, "2024-02-01": 9}
    # the month that did not change is where it was
    assert second.parts["2024-01-01"] == first.parts["2024-01-01"]
    assert table.read(spark, DAILY, second, ["2024-02-01"]).count() == 1


def test_an_absent_table_is_an_error(spark, tmp_path):
    with pytest.raises(NotBuilt):
        monthly(str(tmp_path / "none")).built(spark)
    with pytest.raises(NotBuilt):
        build.check_store(spark, Store(str(tmp_path / "store")))


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    table, first = put(spark, str(tmp_path), *DAYS)
    table.commit(spark, first, DAILY, {"2024-03-01": Part(None)})
    with pytest.raises(CommitConflict):
        table.commit(spark, first, DAILY, {"2024-04-01": Part(None)})
    assert set(table.built(spark).parts) == {"2024-01-01", "2024-02-01", "2024-03-01"}
    assert set(table.put(spark, DAILY, {"2024-04-01": Part(None)}).parts) >= {"2024-04-01"}
    assert not glob.glob(f"{tmp_path}/versions/.draft*")


def test_another_schema_is_refused_for_good(spark, tmp_path):
    table, first = put(spark, str(tmp_path), *DAYS)
    for schema in (DAILY[:-1], RAW):
        with pytest.raises(SchemaChanged):
            table.commit(spark, first, schema, {})
    assert table.current(spark).number == 1


def test_a_failing_rebuild_keeps_the_rows(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, *DAYS)
    fails = spark.range(1).select(F.expr("cast(raise_error('broken') as timestamp_ntz)").alias("pickup_at"))
    with pytest.raises(Exception, match="broken"):
        refresh_daily(spark, lambda first: staged_like(fails), path, full_refresh=True)
    assert newest_date(spark, path) == date(2024, 2, 1)
    assert monthly(path).built(spark).number == 1


def staged_like(rows):
    names = "dropoff_at timestamp_ntz, passenger_count int, trip_distance double, total_amount decimal(10,2), tip_amount decimal(10,2)"
    parts = [p.split() for p in names.split(", ")]
    return rows.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in parts])


def test_failing_zone_and_trends_rebuilds_keep_theirs(spark, tmp_path, monkeypatch):
    landing, store = str(tmp_path / "landing"), Store(str(tmp_path / "store"))
    deliver(spark, landing, "2024-01", 1, 2, 3)
    ingest.load_months(spark, store, landing, ["2024-01"])
    build.build_marts(spark, store)
    before = build.zones(spark, store).collect(), build.trends(spark, store).count()
    broken = lambda *_: spark.range(1).select(F.raise_error(F.lit("broken")).alias("x"))
    monkeypatch.setattr(build, "zones_from_sums", broken)
    with pytest.raises(Exception, match="broken"):
        build.build_marts(spark, store)
    assert (build.zones(spark, store).collect(), build.trends(spark, store).count()) == before


def test_vacuum_removes_what_no_kept_version_names(spark, tmp_path):
    path = str(tmp_path)
    table, _ = put(spark, path, *DAYS)
    put(spark, path, ("2024-02-01", 9, 9))
    _, last = put(spark, path, ("2024-02-01", 8, 8))
    left = table.write(daily(spark, ("2024-05-01", 1, 1)).withColumn("trip_month", F.lit("x")))
    removed = table.vacuum(spark, keep=1)
    assert len(removed) == 3 and set(left.values()) < set(removed)
    assert trips_of(table.read(spark, DAILY, last)) == {"2024-01-30": 3, "2024-02-01": 8}
    assert table.vacuum(spark, keep=1) == []


def test_the_log_is_merged(spark, tmp_path, monkeypatch):
    from datetime import datetime

    monkeypatch.setattr(tables, "LOG_PARTS", 3)
    store, at = Store(str(tmp_path)), datetime(2024, 1, 1)
    for i in range(6):
        append_audit(spark, store, [audit_row("s", f"m{i}", "f", "success", at, at, i)])
    assert sorted(r.rows_loaded for r in read_audit(spark, store).collect()) == list(range(6))
    assert len(tables._log(store.audit).built(spark).parts) <= 3


def test_a_corrupt_month_leaves_the_others_loaded(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), Store(str(tmp_path / "store"))
    deliver(spark, landing, "2024-01", 1)
    deliver(spark, landing, "2024-02", 2)
    create_file(spark, f"{landing}/yellow_tripdata_2024-03.parquet", "not Parquet")
    deliver(spark, landing, "2024-04", 1e9)  # more than its column holds
    deliver(spark, landing, "2024-05", 5)
    months = [f"2024-0{m}" for m in range(1, 6)]
    outcomes = ingest.attempt_months(spark, store, landing, months)
    assert [o.rows for o in outcomes] == [1, 1, None, None, 1]
    assert [o.error is None for o in outcomes] == [True, True, False, False, True]
    assert totals(spark, store) == [1, 2, 5]
    rows = read_audit(spark, store).orderBy("month").collect()
    assert [r.status for r in rows] == ["success", "success", "error", "error", "success"]
    assert all(r.started_at <= r.finished_at for r in rows)
    assert rows[2].finished_at < rows[0].finished_at, "found before anything was written"
    assert "NUMERIC_VALUE_OUT_OF_RANGE" in rows[3].error_message


def loaded(spark, tmp_path, months):
    landing, store = str(tmp_path / "landing"), Store(str(tmp_path / "store"))
    for month, values in months.items():
        deliver(spark, landing, month, *values)
    ingest.load_months(spark, store, landing, list(months))
    return landing, store


def test_facts_answer_without_a_scan(spark, tmp_path):
    landing, store = loaded(spark, tmp_path, {"2024-01": [1, 2], "2024-02": [], "2024-03": [7]})
    facts = {r.source_file[16:23]: r for r in tables.file_facts(spark, store).collect()}
    assert [(m, facts[m].rows) for m in sorted(facts)] == [("2024-01", 2), ("2024-02", 0), ("2024-03", 1)]
    assert str(facts["2024-01"].last_pickup) == "2024-01-02 08:00:00"
    assert facts["2024-02"].loaded_at is None
    assert read_raw(spark, store).count() == 3


def test_the_lookback_opens_no_older_file(spark, tmp_path):
    months = {f"2024-0{m}": range(1, 29) for m in range(1, 6)}
    _, store = loaded(spark, tmp_path, months)
    trips = build.staging(spark, store, date(2024, 4, 28))
    assert {f.split("yellow_tripdata_")[1][:7] for f in trips.inputFiles()} == {"2024-04", "2024-05"}


def test_states_of_unchanged_files_stay(spark, tmp_path):
    landing, store = loaded(spark, tmp_path, {"2024-01": [1, 2], "2024-02": [3], "2024-03": [4]})
    table = store.per_file(per_file.PAIR_SUMS)
    per_file.zone_pair_sums(spark, store)
    first = table.built(spark)
    per_file.zone_pair_sums(spark, store)
    assert table.built(spark).number == first.number, "nothing to do"
    deliver(spark, landing, "2024-02", 30, 40, 50)
    ingest.load_month(spark, store, landing, "2024-02")
    zones = per_file.zones_from_sums(spark, store)
    second = table.built(spark)
    same = {f for f, p in first.parts.items() if second.parts[f] == p}
    assert {f[16:23] for f in same} == {"2024-01", "2024-03"}
    assert not any("raw/trips" in f for f in zones.inputFiles()), "made from the sums alone"
    assert zones.first().total_trips == 6


def test_a_file_of_bad_rows_only_has_an_empty_state(spark, tmp_path):
    landing, store = loaded(spark, tmp_path, {"2024-01": [-5], "2024-02": [3]})
    assert per_file.zones_from_sums(spark, store).first().total_trips == 1
    failures = {(r[1], r[2]): r[3] for r in per_file.staging_failures(spark, store, "m").collect()}
    assert len(failures) == 12 and set(failures.values()) == {0}


def test_trends_are_recomputed_from_the_first_changed_month(spark, tmp_path):
    store = Store(str(tmp_path))
    path = store.mart(build.DAILY_TABLE)
    days = [(f"2024-{m:02d}-{d:02d}", m * d + d % 5, 10 * d) for m in range(1, 7) for d in range(1, 26, 3)]
    put(spark, path, *days)
    build.refresh_trends(spark, store)
    table = monthly(store.mart(build.TRENDS_TABLE))
    first = table.built(spark)
    build.refresh_trends(spark, store)
    assert table.built(spark).number == first.number
    late = [(d, n + 100 * (d == "2024-04-04"), r) for d, n, r in days]
    put(spark, path, *[x for x in late if x[0].startswith("2024-04")])
    build.refresh_trends(spark, store)
    second = table.built(spark)
    kept = {m for m, p in first.parts.items() if second.parts[m] == p}
    assert kept == {"2024-01-01", "2024-02-01", "2024-03-01"}
    want = revenue_trends(daily(spark, *late))
    assert sorted(map(str, build.trends(spark, store).collect())) == sorted(map(str, want.collect()))


def test_carried_rows_may_come_from_several_months(spark, tmp_path):
    store = Store(str(tmp_path))
    path = store.mart(build.DAILY_TABLE)
    days = [(f"2024-{m:02d}-{d:02d}", m + d, 10 * d) for m in range(1, 13) for d in (1, 20)][:20]
    put(spark, path, *days)
    build.refresh_trends(spark, store)
    late = [(d, n + 7 * (d >= "2024-09"), r) for d, n, r in days]
    put(spark, path, *[x for x in late if x[0].startswith(("2024-09", "2024-10"))])
    build.refresh_trends(spark, store)
    want = revenue_trends(daily(spark, *late))
    assert sorted(map(str, build.trends(spark, store).collect())) == sorted(map(str, want.collect()))
