"""Reference answers for the queries over stored tables."""

from __future__ import annotations

from tripwright.plans.oracle import DAILY, ORACLE, TRIPS, ZONE

_MONTHS = f"""WITH {TRIPS},
months AS (
  SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, count(*) AS rows,
    row_number() OVER (ORDER BY strftime(tpep_pickup_datetime, '%Y-%m')) AS nr,
    row_number() OVER (ORDER BY strftime(tpep_pickup_datetime, '%Y-%m') DESC) AS nr_back
  FROM trips GROUP BY 1
)"""


def _steps(*legs: tuple[str, str, str, str]) -> str:
    """Rows (step, month, status, rows) of the months that a condition picks."""
    return f"{_MONTHS}\n" + "\nUNION ALL ".join(
        f"SELECT '{step}' AS step, month, '{status}' AS status, CAST({rows} AS BIGINT) AS rows"
        f" FROM months WHERE {condition}"
        for step, status, rows, condition in legs
    )


ORACLE_STORED: dict[str, str] = {
    "catch_up_gap": _steps(
        ("first call", "stored", "rows", "nr <= 2"),
        ("second call", "stored", "rows", "true"),
        ("audit", "success", "rows", "true"),
        ("audit", "error", "NULL", "nr = 3"),
    ),
    "stream_quarantine": _steps(
        ("first call", "stored", "rows", "nr <> 2"),
        ("first call", "set aside", "NULL", "nr = 2"),
        ("second call", "stored", "rows", "true"),
        ("second call", "healed", "NULL", "nr = 2"),
    ),
    "stored_zone": ORACLE["mart_trips_zone"],
    "stored_checks": ORACLE["dq_report"],
    "stored_daily": ORACLE["mart_trips_daily"],
    "stored_freshness": "SELECT TIMESTAMP '2024-02-01 05:00:00' AS max_loaded_at,"
    " TIMESTAMP '2024-02-01 05:00:00' + to_hours(h) AS as_of,"
    " CAST(h * 3600 AS BIGINT) AS age_seconds,"
    " CASE WHEN h <= 24 THEN 'pass' WHEN h <= 48 THEN 'warn' ELSE 'error' END AS status"
    " FROM (VALUES (6), (24), (30), (49)) v(h)",
    "load_skip": f"{_MONTHS} SELECT true AS skipped, 'nothing due' AS reason,"
    " CAST(2 AS BIGINT) AS audit_rows, CAST(sum(rows) AS BIGINT) AS raw_rows"
    " FROM months WHERE nr_back <= 2",
    "audit_report": f"{_MONTHS} SELECT month, 'success' AS status, rows AS rows_loaded,"
    " CAST(89 + nr AS DECIMAL(10,2)) AS duration_secs,"
    " TIMESTAMP '2024-02-01 00:00:00' + to_hours(nr - 1) AS started_at,"
    " CAST(4 - nr AS BIGINT) AS position FROM months WHERE nr <= 3",
    "daily_in_order": f"WITH {DAILY} SELECT *, row_number() OVER (ORDER BY trip_date) AS position"
    " FROM daily",
    "zones_in_order": f"WITH {ZONE} SELECT *, row_number() OVER"
    " (ORDER BY total_trips DESC NULLS FIRST, pickup_zone_id NULLS LAST) AS position FROM zones",
    "schema_guard": f"WITH {DAILY} SELECT change, refused, (SELECT count(*) FROM daily) AS stored_days"
    " FROM (VALUES ('same columns', false), ('column missing', true), ('column added', true),"
    " ('other type', true), ('other order', true)) v(change, refused)",
}
