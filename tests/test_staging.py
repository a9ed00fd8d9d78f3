from decimal import Decimal

from frames import at, raw

from tripwright.operators.staging import stage_trips
from tripwright.schemas import STAGING


def kept(spark, *rows):
    staged = stage_trips(raw(spark, *[{"vendor_id": i, **row} for i, row in enumerate(rows)]))
    return sorted(row.vendor_id for row in staged.collect())


def test_filter_truth_table(spark):
    eight = at("2024-01-01 08:00")
    assert kept(
        spark,
        {},  # 0
        {"tpep_pickup_datetime": None},
        {"tpep_dropoff_datetime": None},
        {"total_amount": None},
        {"trip_distance": None},
        {"total_amount": 0},  # 5
        {"total_amount": -0.01},
        {"trip_distance": 0.0},  # 7
        {"trip_distance": -0.1},
        {"trip_distance": float("nan")},  # 9: NaN counts as larger than any number
        {"tpep_pickup_datetime": eight, "tpep_dropoff_datetime": eight},
        {"tpep_pickup_datetime": at("2024-01-01 08:21")},
        {"total_amount": 99999999.99},  # 12
    ) == [0, 5, 7, 9, 12]


def test_columns_and_defaults(spark):
    staged = stage_trips(raw(spark, {"airport_fee": None}, {"airport_fee": Decimal("1.25")}))
    assert staged.columns == STAGING.names
    assert [f.dataType for f in staged.schema] == [f.dataType for f in STAGING]
    assert sorted(row.airport_fee for row in staged.collect()) == [Decimal(0), Decimal("1.25")]


def test_duration(spark):
    rows = [
        ("2024-01-01 08:00", "2024-01-01 08:20", "20"),
        ("2024-01-01 08:00", "2024-01-01 08:00:20", "0.333333333"),
        ("2024-01-01 08:00", "2024-01-01 08:00:00.000006", "0.0000001"),
        ("2023-12-31 23:00", "2024-01-02 23:00", "2880"),
        ("2024-03-10 01:30", "2024-03-10 03:30", "120"),  # a clock change in New York
    ]
    previous = spark.conf.get("spark.sql.session.timeZone")
    for zone in (previous, "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            staged = stage_trips(
                raw(
                    spark,
                    *[
                        {"tpep_pickup_datetime": at(p), "tpep_dropoff_datetime": at(d), "vendor_id": i}
                        for i, (p, d, _) in enumerate(rows)
                    ],
                )
            ).orderBy("vendor_id")
            minutes = [row.trip_duration_minutes for row in staged.collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", previous)
        assert minutes == [Decimal(want) for _, _, want in rows]
