"""Declarative checks. A row that fails is returned or counted; NULL only fails not_null."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    column: str
    name: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    strictly: bool = False

    def fails(self) -> str:
        """SQL predicate of the failing rows; ``unique`` has none, it spans rows."""
        if self.name == "not_null":
            return f"{self.column} IS NULL"
        if self.name == "accepted_values":
            return f"{self.column} NOT IN ({', '.join(map(_literal, self.values))})"
        if self.name == "between":
            below, above = ("<=", ">=") if self.strictly else ("<", ">")
            return f"({self.column} {below} {self.low} OR {self.column} {above} {self.high})"
        raise ValueError(f"{self.name} is not a row check")


def _literal(value: int | str) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def unique(column: str) -> Check:
    return Check(column, "unique")


def accepted_values(column: str, values: Sequence) -> Check:
    return Check(column, "accepted_values", values=tuple(values))


def between(column: str, low: float, high: float, strictly: bool = False) -> Check:
    return Check(column, "between", low=low, high=high, strictly=strictly)


def violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failing rows of the row checks, one per row and failed check, in one scan."""
    failed = [
        f"if({check.fails()}, named_struct("
        f"'column_name', '{check.column}', 'check_name', '{check.name}'), NULL)"
        for check in checks
    ]
    # Good rows are dropped by a plain filter, which reaches the scan.
    bad = df.where(" OR ".join(f"({check.fails()})" for check in checks))
    return bad.selectExpr(f"inline(array_compact(array({', '.join(failed)})))", *df.columns)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def _failure_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with a column of failures per check, from one pass over ``df``.

    A uniqueness check turns the pass into a group-by on its key, which then carries
    the counts of the row checks along.
    """
    key = next((c.column for c in checks if c.name == "unique"), None)
    row_counts = [
        F.expr(f"count_if({c.fails()}) AS c{i}") for i, c in enumerate(checks) if c.name != "unique"
    ]
    if key is None:
        return df.agg(*row_counts)
    totals = [
        f"count_if(copies > 1 AND {key} IS NOT NULL)" if c.name == "unique" else f"coalesce(sum(c{i}), 0L)"
        for i, c in enumerate(checks)
    ]
    return (
        df.groupBy(key)
        .agg(F.expr("count(1) AS copies"), *row_counts)
        .agg(*[F.expr(f"{total} AS c{i}") for i, total in enumerate(totals)])
    )


def report(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """(model, column_name, check_name, failures), one row per check."""
    keys = list(dict.fromkeys(c.column for c in checks if c.name == "unique"))
    first = [c for c in checks if c.name != "unique" or c.column == keys[0]]
    passes = [first, *[[unique(key)] for key in keys[1:]]]

    def rows(group: Sequence[Check]) -> DataFrame:
        entries = ", ".join(f"'{c.column}', '{c.name}', c{i}" for i, c in enumerate(group))
        return _failure_counts(df, group).selectExpr(
            f"'{model}' AS model",
            f"stack({len(group)}, {entries}) AS (column_name, check_name, failures)",
        )

    return reduce(DataFrame.unionByName, [rows(group) for group in passes])


def failures_by_key(df: DataFrame, key: str, checks: Sequence[Check]) -> DataFrame:
    """(key, column_name, check_name, failures) of row checks, one row per key and check."""
    counts = [F.expr(f"count_if({c.fails()}) AS c{i}") for i, c in enumerate(checks)]
    entries = ", ".join(f"'{c.column}', '{c.name}', c{i}" for i, c in enumerate(checks))
    return (
        df.groupBy(key)
        .agg(*counts)
        .selectExpr(key, f"stack({len(checks)}, {entries}) AS (column_name, check_name, failures)")
    )


def freshness(
    df: DataFrame,
    loaded_at: str,
    as_of: Sequence[datetime],
    warn_after: timedelta = timedelta(days=1),
    error_after: timedelta = timedelta(days=2),
) -> DataFrame:
    """Age of the newest row at each ``as_of`` and its status; no rows at all is an error."""
    moments = F.array(*[F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in as_of])
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = F.expr("timestampdiff(SECOND, max_loaded_at, as_of)")
    late = F.col("as_of") - F.col("max_loaded_at")
    return newest.select("max_loaded_at", F.explode(moments).alias("as_of")).select(
        "max_loaded_at",
        "as_of",
        age.alias("age_seconds"),
        F.when(late <= F.lit(warn_after), "pass")
        .when(late <= F.lit(error_after), "warn")
        .otherwise("error")
        .alias("status"),
    )
