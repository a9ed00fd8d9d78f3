from datetime import date, datetime

from pyspark.sql import functions as F

from tripwright.functions.months import (
    filename_in,
    following_month,
    month_to_filename,
    months_due,
    next_month,
)


def test_file_names():
    names = [month_to_filename(f"{year}-{month:02d}") for year in (1999, 2031) for month in (2, 10)]
    assert names == [
        f"yellow_tripdata_{month}.parquet" for month in ("1999-02", "1999-10", "2031-02", "2031-10")
    ]


def test_next_month():
    now = datetime(2025, 3, 15)
    assert next_month(None, now) == "2024-01"
    assert next_month(date(2024, 5, 1), now) == "2024-06"
    assert next_month(date(2024, 12, 1), now) == "2025-01"
    assert next_month(date(2025, 2, 1), now) == "2025-03"  # the running month is due
    assert next_month(date(2025, 3, 1), now) is None
    assert next_month(None, datetime(2023, 12, 31)) is None


def test_months_due():
    assert months_due(date(2024, 11, 1), date(2025, 2, 1)) == ["2024-12", "2025-01", "2025-02"]
    assert months_due(date(2025, 2, 1), date(2025, 2, 28)) == []


def test_column_forms(spark):
    row = spark.range(1).select(
        filename_in(F.lit("s3://b/yellow_tripdata_old/yellow_tripdata_2024-07.parquet")).alias("file"),
        filename_in(F.lit("/l/source_file=yellow_tripdata_2024-07.parquet/part-0.parquet")).alias("part"),
        following_month(F.lit(date(2024, 12, 1))).alias("following"),
    ).first()
    assert row["file"] == row["part"] == "yellow_tripdata_2024-07.parquet"
    assert row["following"] == "2025-01"
