"""Reference answers in DuckDB SQL over the same tables.

Written independently of the Spark code: rounding is whole-number arithmetic over
cents, quarter miles and minutes, which has no intermediate precision to lose.
"""

from __future__ import annotations


def _round(num: str, den: str, digits: int) -> str:
    """num / den to ``digits`` decimals, half away from zero; NULL for den = 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    whole = f"(sign({n}) * ((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d}))))"
    unit = f"CAST({10**-digits:.{digits}f} AS DECIMAL({digits + 1},{digits}))"
    return f"CAST(CAST({whole} AS DECIMAL(17,0)) * {unit} AS DECIMAL(18,{digits}))"


def _cents(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(6,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"


TRIPS = f"""
lines AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c,
    l_shipdate + to_minutes(CAST((l_orderkey * 7 + l_linenumber * 131) % 1440 AS BIGINT)) AS p
  FROM lineitem
),
trips AS (
  SELECT CAST(l_linenumber % 2 + 1 AS INT) AS vendor_id,
    CAST(p AS TIMESTAMP) AS tpep_pickup_datetime,
    CAST(CASE WHEN (l_orderkey + l_linenumber) % 500 = 0 THEN NULL
      ELSE p + to_minutes(CAST(l_quantity AS BIGINT) - 3) END AS TIMESTAMP) AS tpep_dropoff_datetime,
    CAST(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber % 6 + 1 END AS INT) AS passenger_count,
    CAST(l_quantity / 4 AS DOUBLE) AS trip_distance,
    CAST(l_partkey % 6 + 1 AS INT) AS ratecode_id,
    CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_suppkey % 263 + 1 AS INT) AS pu_location_id,
    CAST(CASE WHEN l_orderkey % 400 = 1 THEN NULL ELSE l_partkey % 263 + 1 END AS INT) AS do_location_id,
    CAST(l_partkey % 7 AS INT) AS payment_type,
    {_cents("c % 9000")} AS fare_amount,
    CAST(0.50 AS DECIMAL(10,2)) AS extra,
    CAST(0.50 AS DECIMAL(10,2)) AS mta_tax,
    {_cents("c % 700")} AS tip_amount,
    CAST(0 AS DECIMAL(10,2)) AS tolls_amount,
    CAST(0.30 AS DECIMAL(10,2)) AS improvement_surcharge,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN {_cents("-(c % 9000) - 1")}
      ELSE {_cents("c % 9000 + c % 700")} END AS total_amount,
    CAST(2.50 AS DECIMAL(10,2)) AS congestion_surcharge,
    CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(1.25 AS DECIMAL(10,2)) END AS airport_fee,
    'yellow_tripdata_' || strftime(p, '%Y-%m') || '.parquet' AS source_file,
    TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
  FROM lines
)"""

STAGED = f"""{TRIPS},
staged AS (
  SELECT vendor_id, pu_location_id, do_location_id, tpep_pickup_datetime AS pickup_at,
    tpep_dropoff_datetime AS dropoff_at, passenger_count, trip_distance, ratecode_id,
    store_and_fwd_flag, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, congestion_surcharge,
    coalesce(airport_fee, CAST(0 AS DECIMAL(10,2))) AS airport_fee, total_amount,
    CAST(date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS DECIMAL(27,9))
      AS trip_duration_minutes,
    source_file, loaded_at
  FROM trips
  WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND total_amount >= 0 AND trip_distance >= 0
    AND tpep_dropoff_datetime > tpep_pickup_datetime
),
units AS (
  SELECT *, CAST(pickup_at AS DATE) AS trip_date,
    CAST(total_amount * 100 AS BIGINT) AS cents, CAST(tip_amount * 100 AS BIGINT) AS tip_cents,
    CAST(trip_distance * 4 AS BIGINT) AS quarters,
    date_diff('minute', pickup_at, dropoff_at) AS minutes
  FROM staged
)"""

DAILY = f"""{STAGED},
daily AS (
  SELECT trip_date, count(*) AS total_trips,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    {_round("sum(quarters)", "4", 2)} AS total_distance_miles,
    {_round("sum(quarters)", "4 * count(*)", 2)} AS avg_distance_miles,
    {_round("sum(minutes)", "count(*)", 1)} AS avg_duration_minutes,
    {_round("sum(cents)", "100", 2)} AS total_revenue,
    {_round("sum(cents)", "100 * count(*)", 2)} AS avg_fare,
    {_round("sum(tip_cents)", "100", 2)} AS total_tips,
    {_round("sum(tip_cents)", "100 * count(tip_cents)", 2)} AS avg_tip,
    {_round("100 * sum(tip_cents)", "sum(cents)", 2)} AS tip_pct_of_revenue
  FROM units GROUP BY trip_date
)"""

ZONE = f"""{STAGED},
pairs AS (
  SELECT pu_location_id, do_location_id, count(*) AS n FROM staged
  WHERE do_location_id IS NOT NULL GROUP BY ALL
),
modes AS (
  SELECT pu_location_id, do_location_id, n FROM pairs
  QUALIFY row_number() OVER (PARTITION BY pu_location_id ORDER BY n DESC, do_location_id) = 1
),
zones AS (
  SELECT u.pu_location_id AS pickup_zone_id, count(*) AS total_trips,
    any_value(m.do_location_id) AS most_common_dropoff_zone,
    {_round("sum(quarters)", "4 * count(*)", 2)} AS avg_distance_miles,
    {_round("sum(cents)", "100", 2)} AS total_revenue,
    {_round("sum(cents)", "100 * count(*)", 2)} AS avg_fare,
    {_round("sum(tip_cents)", "100 * count(tip_cents)", 2)} AS avg_tip,
    {_round("sum(minutes)", "count(*)", 1)} AS avg_duration_minutes
  FROM units u LEFT JOIN modes m ON u.pu_location_id IS NOT DISTINCT FROM m.pu_location_id
  GROUP BY u.pu_location_id
)"""


def _trends(frame: str, week_ago: str) -> str:
    """Trends from daily rows; ``week_ago`` is a join condition between c and o."""
    cents = "CAST(total_revenue * 100 AS BIGINT)"
    return f"""{DAILY},
numbered AS (
  SELECT *, {cents} AS rev, row_number() OVER (ORDER BY trip_date) AS rn FROM daily
),
averaged AS (
  SELECT *, sum(total_trips) OVER w AS trips_w, sum(rev) OVER w AS rev_w, count(*) OVER w AS n_w
  FROM numbered WINDOW w AS ({frame})
),
trends AS (
  SELECT c.trip_date, CAST(extract(dow FROM c.trip_date) AS INT) AS day_of_week, c.total_trips,
    c.total_revenue, c.avg_fare, c.avg_tip, c.tip_pct_of_revenue,
    {_round("c.trips_w", "c.n_w", 1)} AS trips_7d_moving_avg,
    {_round("c.rev_w", "100 * c.n_w", 2)} AS revenue_7d_moving_avg,
    o.total_trips AS trips_same_day_last_week,
    o.total_revenue AS revenue_same_day_last_week,
    {_round("100 * (c.total_trips - o.total_trips)", "o.total_trips", 2)} AS trips_wow_growth_pct,
    {_round("100 * (c.rev - o.rev)", "o.rev", 2)} AS revenue_wow_growth_pct,
    CAST(rank() OVER (PARTITION BY date_trunc('month', c.trip_date) ORDER BY c.rev DESC) AS INT)
      AS revenue_rank_in_month
  FROM averaged c LEFT JOIN numbered o ON {week_ago}
),
labelled AS (
  SELECT *, CASE WHEN trips_wow_growth_pct > 10 THEN 'growing'
    WHEN trips_wow_growth_pct < -10 THEN 'declining'
    WHEN trips_wow_growth_pct IS NULL THEN 'insufficient_data' ELSE 'stable' END AS demand_trend
  FROM trends
)"""


TRENDS = _trends("ORDER BY trip_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW", "o.rn = c.rn - 7")
CALENDAR = _trends(
    "ORDER BY trip_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW",
    "o.trip_date = c.trip_date - 7",
)

SOURCE_COLUMNS = """vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
  trip_distance, ratecode_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type,
  fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
  congestion_surcharge"""

_CHECKS = {
    "stg_yellow_trips": (
        "units",
        [
            ("pickup_at", "not_null", "pickup_at IS NULL"),
            ("dropoff_at", "not_null", "dropoff_at IS NULL"),
            ("total_amount", "not_null", "total_amount IS NULL"),
            ("total_amount", "between", "total_amount NOT BETWEEN 0 AND 1000"),
            ("trip_distance", "not_null", "trip_distance IS NULL"),
            ("trip_distance", "between", "trip_distance NOT BETWEEN 0 AND 500"),
            ("passenger_count", "between", "passenger_count NOT BETWEEN 0 AND 9"),
            ("pu_location_id", "not_null", "pu_location_id IS NULL"),
            ("do_location_id", "not_null", "do_location_id IS NULL"),
            ("payment_type", "accepted_values", "payment_type NOT IN (0, 1, 2, 3, 4, 5, 6)"),
            ("trip_duration_minutes", "not_null", "minutes IS NULL"),
            ("trip_duration_minutes", "between", "minutes <= 0 OR minutes >= 600"),
        ],
    ),
    "mart_trips_daily": (
        "daily",
        [
            ("trip_date", "not_null", "trip_date IS NULL"),
            ("trip_date", "unique", None),
            ("total_trips", "not_null", "total_trips IS NULL"),
            ("total_revenue", "not_null", "total_revenue IS NULL"),
            ("avg_fare", "not_null", "avg_fare IS NULL"),
        ],
    ),
    "mart_trips_zone": (
        "zones",
        [
            ("pickup_zone_id", "not_null", "pickup_zone_id IS NULL"),
            ("pickup_zone_id", "unique", None),
            ("total_trips", "not_null", "total_trips IS NULL"),
            ("total_revenue", "not_null", "total_revenue IS NULL"),
        ],
    ),
    "mart_revenue_trends": (
        "labelled",
        [
            ("trip_date", "not_null", "trip_date IS NULL"),
            ("trip_date", "unique", None),
            ("trips_7d_moving_avg", "not_null", "trips_7d_moving_avg IS NULL"),
            ("revenue_7d_moving_avg", "not_null", "revenue_7d_moving_avg IS NULL"),
            ("revenue_rank_in_month", "not_null", "revenue_rank_in_month IS NULL"),
            ("demand_trend", "not_null", "demand_trend IS NULL"),
            (
                "demand_trend",
                "accepted_values",
                "demand_trend NOT IN ('growing', 'stable', 'declining', 'insufficient_data')",
            ),
        ],
    ),
}


def _report() -> str:
    # the zone block starts with the staging block the trends block has as well
    both = TRENDS + ZONE[len(STAGED):]
    legs = []
    for model, (table, checks) in _CHECKS.items():
        for column, name, failing in checks:
            counted = (
                f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL"
                f" GROUP BY 1 HAVING count(*) > 1))"
                if failing is None
                else f"(SELECT count(*) FROM {table} WHERE {failing})"
            )
            legs.append(
                f"SELECT '{model}' AS model, '{column}' AS column_name, '{name}' AS check_name,"
                f" {counted} AS failures"
            )
    return f"WITH {both}\n" + "\nUNION ALL ".join(legs)


def _violations(table: str, columns: str, checks: list[tuple[str, str, str]], cte: str) -> str:
    legs = [
        f"SELECT '{column}' AS column_name, '{name}' AS check_name, {columns} FROM {table} WHERE {failing}"
        for column, name, failing in checks
    ]
    return f"WITH {cte}\n" + "\nUNION ALL ".join(legs)


_RAW_ROWS = f"WITH {TRIPS} SELECT * FROM trips"
_DAILY_ROWS = f"WITH {DAILY} SELECT * FROM daily"
_LABELLED = f"WITH {TRENDS} SELECT * FROM labelled"
_NEXT = "strftime(max(date_trunc('month', tpep_pickup_datetime)) + INTERVAL 1 MONTH, '%Y-%m')"

ORACLE: dict[str, str] = {
    "trips_raw": _RAW_ROWS,
    "raw_normalize": f"WITH {TRIPS} SELECT {SOURCE_COLUMNS},"
    " CAST(NULL AS DECIMAL(10,2)) AS airport_fee FROM trips",
    "stg_trips": f"WITH {STAGED} SELECT * FROM staged",
    "mart_trips_daily": _DAILY_ROWS,
    "mart_trips_zone": f"WITH {ZONE} SELECT * FROM zones",
    "mart_revenue_trends": _LABELLED,
    "zone_mode_dropoff": f"WITH {ZONE} SELECT z.pickup_zone_id AS pu_location_id, m.do_location_id,"
    " m.n AS occurrences FROM zones z LEFT JOIN modes m"
    " ON z.pickup_zone_id IS NOT DISTINCT FROM m.pu_location_id",
    "trip_totals": f"WITH {STAGED} SELECT max(trip_date) AS newest_date, count(*) AS total_trips,"
    f" {_round('sum(cents)', '100 * count(*)', 2)} AS avg_fare FROM units",
    "moving_avg_7": f"WITH {TRENDS} SELECT trip_date, total_trips, total_revenue,"
    " trips_7d_moving_avg, revenue_7d_moving_avg FROM labelled",
    "wow_growth": f"WITH {TRENDS} SELECT trip_date, total_trips, total_revenue,"
    " trips_same_day_last_week, revenue_same_day_last_week, trips_wow_growth_pct,"
    " revenue_wow_growth_pct FROM labelled",
    "revenue_rank_in_month": f"WITH {TRENDS} SELECT trip_date, total_revenue,"
    " revenue_rank_in_month FROM labelled",
    "demand_trend_counts": f"WITH {TRENDS} SELECT demand_trend, count(*) AS days FROM labelled"
    " GROUP BY demand_trend",
    "trends_calendar": f"WITH {CALENDAR} SELECT * FROM labelled",
    "dq_not_null": _violations(
        "trips",
        "tpep_pickup_datetime, tpep_dropoff_datetime, do_location_id, total_amount",
        [
            ("tpep_pickup_datetime", "not_null", "tpep_pickup_datetime IS NULL"),
            ("tpep_dropoff_datetime", "not_null", "tpep_dropoff_datetime IS NULL"),
            ("do_location_id", "not_null", "do_location_id IS NULL"),
            ("total_amount", "not_null", "total_amount IS NULL"),
        ],
        TRIPS,
    ),
    "dq_unique": f"WITH {ZONE}, days AS (SELECT DISTINCT trip_date FROM units)"
    " SELECT 'stg_yellow_trips' AS model, CAST(pu_location_id AS VARCHAR) AS duplicate_key,"
    " count(*) AS copies FROM staged WHERE pu_location_id IS NOT NULL GROUP BY pu_location_id"
    " HAVING count(*) > 1"
    " UNION ALL SELECT 'mart_trips_daily', CAST(trip_date AS VARCHAR), count(*) FROM days"
    " GROUP BY trip_date HAVING count(*) > 1"
    " UNION ALL SELECT 'mart_trips_zone', CAST(pickup_zone_id AS VARCHAR), count(*) FROM zones"
    " WHERE pickup_zone_id IS NOT NULL GROUP BY pickup_zone_id HAVING count(*) > 1",
    "dq_accepted_values": _violations(
        "staged",
        "pickup_at, pu_location_id, payment_type",
        [("payment_type", "accepted_values", "payment_type NOT IN (1, 2)")],
        STAGED,
    ),
    "dq_between": _violations(
        "trips",
        "tpep_pickup_datetime, pu_location_id, total_amount, trip_distance",
        [
            ("total_amount", "between", "total_amount NOT BETWEEN 0 AND 1000"),
            ("trip_distance", "between", "trip_distance <= 0.25 OR trip_distance >= 12.5"),
        ],
        TRIPS,
    ),
    "dq_freshness": f"WITH {TRIPS}, newest AS (SELECT max(loaded_at) AS max_loaded_at FROM trips)"
    " SELECT max_loaded_at, max_loaded_at + to_hours(h) AS as_of,"
    " CAST(h * 3600 AS BIGINT) AS age_seconds,"
    " CASE WHEN h <= 24 THEN 'pass' WHEN h <= 48 THEN 'warn' ELSE 'error' END AS status"
    " FROM newest, (VALUES (6), (24), (30), (49)) v(h)",
    "dq_report": _report(),
    "daily_incremental": _DAILY_ROWS,
    "daily_upsert": f"WITH {DAILY} SELECT * REPLACE (CASE WHEN day(trip_date) = 1"
    " THEN CAST(0 AS DECIMAL(18,2)) ELSE total_tips END AS total_tips) FROM daily",
    "load_month_idempotent": _RAW_ROWS,
    "watermark_next_month": f"WITH {TRIPS} SELECT 'nyc_taxi_yellow' AS source_name,"
    " CAST(date_trunc('month', max(tpep_pickup_datetime)) AS DATE) AS last_loaded_month,"
    f" {_NEXT} AS next_month FROM trips",
    "audit_log": f"WITH {TRIPS}, months AS (SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month,"
    " 'success' AS status, count(*) AS rows_loaded, false AS has_error FROM trips GROUP BY 1"
    f" UNION ALL SELECT {_NEXT}, 'error', NULL, true FROM trips)"
    " SELECT 'nyc_taxi_yellow' AS source_name, month,"
    " 'yellow_tripdata_' || month || '.parquet' AS source_file, status, rows_loaded, has_error"
    " FROM months",
    "stored_marts": _LABELLED,
    "stream_ingest": _RAW_ROWS,
    "raw_file_summary": f"WITH {TRIPS} SELECT source_file, count(*) AS rows,"
    " min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup"
    " FROM trips GROUP BY source_file",
    "top_zones": f"WITH {ZONE} SELECT pickup_zone_id, total_trips, total_revenue, avg_fare FROM zones"
    " ORDER BY total_trips DESC, pickup_zone_id LIMIT 10",
    "latest_days": f"WITH {DAILY} SELECT trip_date, total_trips, total_revenue, avg_fare FROM daily"
    " ORDER BY trip_date DESC LIMIT 10",
    "latest_trends": f"WITH {TRENDS} SELECT trip_date, day_of_week, total_revenue,"
    " revenue_7d_moving_avg, revenue_wow_growth_pct, demand_trend, revenue_rank_in_month"
    " FROM labelled ORDER BY trip_date DESC LIMIT 14",
}
