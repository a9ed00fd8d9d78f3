from datetime import datetime, timezone
from decimal import Decimal

from frames import CAMEL_ROW, frame

from tripwright.operators.normalize import normalize_columns, raw_rows
from tripwright.schemas import RAW

SOURCE_NAMES = RAW.names[:19]


def without(*names):
    return {name: value for name, value in CAMEL_ROW.items() if name not in names}


def test_names_order_types_and_values(spark):
    result = normalize_columns(frame(spark, CAMEL_ROW))
    assert result.columns == SOURCE_NAMES
    assert [f.dataType for f in result.schema] == [f.dataType for f in RAW][:19]
    row = result.first()
    assert (row.vendor_id, row.pu_location_id, row.do_location_id) == (2, 48, 231)
    assert row.total_amount == Decimal("39.44")
    assert row.tpep_pickup_datetime == datetime(2024, 1, 9, 17, 5)


def test_missing_column_is_null(spark):
    result = normalize_columns(frame(spark, without("Airport_fee")))
    assert result.columns == SOURCE_NAMES
    assert result.first().airport_fee is None


def test_unknown_columns_are_dropped(spark):
    result = normalize_columns(frame(spark, {**CAMEL_ROW, "weather": "x"}))
    assert result.columns == SOURCE_NAMES


def test_already_normalized_header_passes(spark):
    row = {**without("Airport_fee", "VendorID"), "airport_fee": 1.25, "vendor_id": 2}
    first = normalize_columns(frame(spark, row)).first()
    assert (first.airport_fee, first.vendor_id) == (Decimal("1.25"), 2)


def test_headers_match_by_exact_case(spark):
    row = {**without("passenger_count"), "Passenger_Count": 9}
    assert normalize_columns(frame(spark, row)).first().passenger_count is None
    # next to the right header a wrong-case one is an unknown column, not an ambiguity
    row = {**CAMEL_ROW, "Passenger_Count": 9, "AIRPORT_FEE": 9.0}
    first = normalize_columns(frame(spark, row)).first()
    assert (first.passenger_count, first.airport_fee) == (4, Decimal("1.75"))


def test_loose_numbers(spark):
    rows = [
        {**CAMEL_ROW, "passenger_count": value, "trip_distance": miles, "total_amount": total}
        for value, miles, total in [
            (2.5, 1.0, 2.675),
            (1.4, float("nan"), 0.125),
            (float("nan"), 2.0, -0.125),
            (None, None, float("nan")),
        ]
    ]
    result = normalize_columns(frame(spark, *rows)).collect()
    assert [row.passenger_count for row in result] == [3, 1, None, None]
    assert [row.trip_distance for row in result] == [1.0, None, 2.0, None]
    assert [row.total_amount for row in result] == [
        Decimal("2.68"), Decimal("0.13"), Decimal("-0.13"), None,
    ]


def test_provenance(spark):
    delivered = frame(spark, CAMEL_ROW)
    rows = raw_rows(delivered, "some_file.parquet", datetime(2024, 2, 1))
    assert rows.columns == RAW.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in RAW]
    row = rows.first()
    assert (row.source_file, row.loaded_at) == ("some_file.parquet", datetime(2024, 2, 1))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        now = raw_rows(delivered, "f").first().loaded_at
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - now).total_seconds()) < 600
