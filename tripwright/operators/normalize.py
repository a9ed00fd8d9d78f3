"""Monthly file rows to raw rows: names, order, types, provenance."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.schemas import HEADER_TO_NAME, SOURCE_COLUMNS


def _names(schema: T.StructType) -> list[str]:
    """Column names by exact header, for a rename by position.

    Headers match by case while Spark's name resolution does not, so a column that is
    not expected gets a name no lookup can hit.
    """
    expected = set(HEADER_TO_NAME.values())
    names = [HEADER_TO_NAME.get(header, header) for header in schema.names]
    return [name if name in expected else f"_extra_{i}" for i, name in enumerate(names)]


def _as_type(name: str, have: T.DataType, want: T.DataType) -> str:
    fractional = isinstance(have, (T.FloatType, T.DoubleType))
    value = f"nanvl(CAST({name} AS DOUBLE), CAST(NULL AS DOUBLE))" if fractional else name
    if isinstance(want, T.IntegerType) and (fractional or isinstance(have, T.DecimalType)):
        value = f"round({value})"  # a bare cast would truncate
    return f"CAST({value} AS {want.simpleString()}) AS {name}"


def _typed_columns(schema: T.StructType) -> list[str]:
    have = dict(zip(_names(schema), (field.dataType for field in schema)))
    return [
        _as_type(name, have[name], want)
        if name in have
        else f"CAST(NULL AS {want.simpleString()}) AS {name}"
        for _, name, want in SOURCE_COLUMNS
    ]


def normalize_columns(df: DataFrame) -> DataFrame:
    """The 19 source columns in table order: absent ones NULL, unknown ones dropped."""
    return df.toDF(*_names(df.schema)).selectExpr(_typed_columns(df.schema))


def raw_rows(
    scan: DataFrame, source_file: str | Column, loaded_at: datetime | None = None
) -> DataFrame:
    """Normalized rows, the file they came from and the load time (UTC in any session zone)."""
    utc = "to_utc_timestamp(current_timestamp(), current_timezone())"
    now = utc if loaded_at is None else f"TIMESTAMP_NTZ'{loaded_at}'"
    file = F.lit(source_file) if isinstance(source_file, str) else source_file
    return (
        scan.select("*", file)
        .toDF(*_names(scan.schema), "source_file")
        .selectExpr(
            *_typed_columns(scan.schema),
            "source_file",
            f"CAST({now} AS TIMESTAMP_NTZ) AS loaded_at",
        )
    )
