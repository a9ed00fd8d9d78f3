"""Run queries on Spark and their reference SQL on DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def rows_by_name(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def duck_type(dtype) -> str:
    """Spark's name for a DuckDB type."""
    name = str(dtype).lower()
    plain = {"integer": "int", "varchar": "string", "timestamp": "timestamp_ntz"}
    return plain.get(name, name)


def differences(spark, sf_dir: str, query, sql: str) -> str:
    """Empty when both give the same columns, types and multiset of exact values."""
    frame = query(spark, sf_dir)
    result = duck(sf_dir).sql(sql)
    types = dict(frame.dtypes)
    want_types = {c: duck_type(t) for c, t in zip(result.columns, result.types)}
    if types != want_types:
        return f"types {set(types.items()) ^ set(want_types.items())}"
    got = rows_by_name(frame.columns, frame.collect())
    want = rows_by_name(result.columns, result.fetchall())
    if got != want:
        return f"only spark {list((got - want).items())[:2]} only sql {list((want - got).items())[:2]}"
    return "" if got else "no rows on either side"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as contract
    from tripwright.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            sql = contract.oracle_sql().get(name)
            verdict = differences(spark, folder, query, sql) if sql else f"{query(spark, folder).count()} rows, no SQL"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24} {time.time() - started:6.1f}s  {verdict or 'same'}", flush=True)
