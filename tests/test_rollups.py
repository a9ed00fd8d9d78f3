import random
from decimal import ROUND_HALF_UP, Decimal, localcontext
from fractions import Fraction

from frames import at, staged
from pyspark.sql import functions as F

from tripwright.functions.exact import ratio
from tripwright.operators.rollups import daily_mart, file_summary, mode_per_key, zone_mart
from tripwright.schemas import DAILY, ZONE


def half_up(value: Fraction, digits: int) -> Decimal:
    scaled = abs(value) * 10**digits
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Decimal(whole * (1 if value >= 0 else -1)).scaleb(-digits)


def test_ratio_rounds_once(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(-(10**n), 10**n), rng.randint(1, 10**m)) for n in range(1, 16) for m in range(1, 12)]
    pairs += [(2 * k + 1, 200) for k in range(-50, 50)]  # exact ties
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = df.select("n", "d", F.expr(ratio("n", "d", 2)).alias("r")).collect()
    assert all(row.r == half_up(Fraction(row.n, row.d), 2) for row in got)
    zero = spark.sql("select 1L as n, 0L as d").selectExpr(ratio("n", "d", 2)).first()
    assert zero[0] is None


def test_mean_is_not_rounded_twice(spark):
    """1,000,001 x 1.00 and 1,000,000 x 1.01: the mean lies just below 1.005."""
    n = 2_000_001
    trips = staged(spark, {}).drop("total_amount").crossJoin(
        spark.range(n).select(
            F.expr(f"cast(if(id <= 1000000, 1.00, 1.01) as decimal(10,2)) as total_amount")
        )
    )
    row = daily_mart(trips).first()
    assert (row.total_trips, row.avg_fare) == (n, Decimal("1.00"))
    assert zone_mart(trips).first().avg_fare == Decimal("1.00")


def test_daily_golden(spark):
    mart = daily_mart(
        staged(
            spark,
            {"day": "2024-01-01", "passenger_count": 2, "trip_distance": 1.25, "minutes": 10,
             "total_amount": 10.00, "tip_amount": 1.00},
            {"day": "2024-01-01", "passenger_count": None, "trip_distance": 2.5, "minutes": 15,
             "total_amount": 20.01, "tip_amount": 2.00},
            {"day": "2024-01-02", "passenger_count": None, "trip_distance": 0.0, "seconds": 10,
             "total_amount": 0, "tip_amount": None},
        )
    )
    assert mart.columns == DAILY.names
    assert [f.dataType for f in mart.schema] == [f.dataType for f in DAILY]
    first, second = mart.orderBy("trip_date").collect()
    assert tuple(first)[1:] == (
        2, 2, Decimal("3.75"), Decimal("1.88"), Decimal("12.5"), Decimal("30.01"),
        Decimal("15.01"), Decimal("3.00"), Decimal("1.50"), Decimal("10.00"),
    )
    # no passengers known, no revenue, no tip known
    assert tuple(second)[1:] == (
        1, None, Decimal("0.00"), Decimal("0.00"), Decimal("0.2"), Decimal("0.00"),
        Decimal("0.00"), None, None, None,
    )


def test_tip_average_skips_unknown_tips(spark):
    mart = daily_mart(staged(spark, {"tip_amount": 3}, {"tip_amount": None}, {"tip_amount": 2}))
    assert mart.first().avg_tip == Decimal("2.50")


def test_sub_second_durations_add_up(spark):
    """Three times 10 s is half a minute, although 1/6 minute has no exact decimal."""
    pickup = at("2024-01-01 08:00:00.000001")
    mart = daily_mart(staged(spark, *[{"pickup_at": pickup, "seconds": s} for s in (9.4, 9.3, 11.3)]))
    assert mart.first().avg_duration_minutes == Decimal("0.2")
    mart = daily_mart(staged(spark, *[{"seconds": s} for s in (2.4, 3.6)]))  # 0.05 exactly
    assert mart.first().avg_duration_minutes == Decimal("0.1")
    mart = daily_mart(staged(spark, *[{"seconds": s} for s in (2.4, 3.599999)]))
    assert mart.first().avg_duration_minutes == Decimal("0.0")


def test_distance_without_a_value(spark):
    bad = staged(spark, {"trip_distance": float("nan")}, {"trip_distance": 2.0})
    worse = staged(spark, {"day": "2024-01-02", "trip_distance": float("inf")})
    fine = staged(spark, {"day": "2024-01-03", "trip_distance": 2.345})
    rows = daily_mart(bad.union(worse).union(fine)).orderBy("trip_date").collect()
    # what is no distance is left out, the others of the day count
    assert [row.total_distance_miles for row in rows] == [Decimal("2.00"), None, Decimal("2.35")]
    assert [row.avg_distance_miles for row in rows] == [Decimal("2.00"), None, Decimal("2.35")]
    assert [row.total_trips for row in rows] == [2, 1, 1]


def test_a_distance_that_cannot_be_one_aborts_nothing(spark):
    trips = staged(spark, {"trip_distance": 1e19}, {"day": "2024-01-02", "trip_distance": 2.5})
    assert [r.total_distance_miles for r in daily_mart(trips).orderBy("trip_date").collect()] == [
        None, Decimal("2.50"),
    ]


def test_sums_do_not_depend_on_order(spark):
    rng = random.Random(3)
    miles = [rng.randint(0, 10**6) / 100 for _ in range(3000)]
    trips = staged(spark, *[{"trip_distance": m} for m in miles])
    results = {
        daily_mart(trips.orderBy(F.rand(seed)).repartition(seed + 1)).first() for seed in range(3)
    }
    assert len(results) == 1
    with localcontext(rounding=ROUND_HALF_UP):
        assert results.pop().total_distance_miles == sum(Decimal(str(m)) for m in miles)


def test_zone_golden(spark):
    mart = zone_mart(
        staged(
            spark,
            *[{"pu_location_id": 1, "do_location_id": do} for do in (3, 1, 3, 1, None, None, None, 2)],
            {"pu_location_id": 2, "do_location_id": None},
            {"pu_location_id": None, "do_location_id": 7, "total_amount": 3.33},
        )
    )
    assert mart.columns == ZONE.names
    assert [f.dataType for f in mart.schema] == [f.dataType for f in ZONE]
    rows = {row.pickup_zone_id: row for row in mart.collect()}
    assert rows[1].most_common_dropoff_zone == 1  # tied with 3, and NULL is no zone
    assert rows[2].most_common_dropoff_zone is None
    assert rows[None].most_common_dropoff_zone == 7  # an unknown pickup zone is a group
    assert [rows[k].total_trips for k in (1, 2, None)] == [8, 1, 1]
    assert rows[None].total_revenue == Decimal("3.33")


def test_mode_per_key(spark):
    df = spark.createDataFrame(
        [("a", 5), ("a", 5), ("a", 2), ("b", 9), ("b", 4), ("c", None), (None, 1)], "k string, v int"
    )
    got = {row.k: (row.v, row.occurrences) for row in mode_per_key(df, "k", "v").collect()}
    assert got == {"a": (5, 2), "b": (4, 1), "c": (None, None), None: (1, 1)}
    spark_mode = df.groupBy("k").agg(F.mode("v", deterministic=True).alias("v")).collect()
    assert {row.k: row.v for row in spark_mode} == {k: v for k, (v, _) in got.items()}


def test_file_summary(spark):
    from frames import raw

    rows = raw(
        spark,
        {"source_file": "a"},
        {"source_file": "a", "tpep_pickup_datetime": at("2024-01-05 00:00")},
        {"source_file": "b", "tpep_pickup_datetime": None},
    )
    got = {row.source_file: tuple(row)[1:] for row in file_summary(rows).collect()}
    assert got == {"a": (2, at("2024-01-01 08:00"), at("2024-01-05 00:00")), "b": (1, None, None)}
