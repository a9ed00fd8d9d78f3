"""Month names, file names and the month that is due next."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwright.schemas import FILE_PREFIX, FILE_SUFFIX, FIRST_MONTH


def month_to_filename(month: str) -> str:
    return FILE_PREFIX + month + FILE_SUFFIX


def month_start(month: str) -> date:
    return date.fromisoformat(f"{month}-01")


def month_of(moment: date | datetime) -> str:
    return f"{moment:%Y-%m}"


def next_month(last: date | None, now: date | datetime) -> str | None:
    """The month after ``last``, or None while it still lies in the future."""
    if last is None:
        due = FIRST_MONTH
    else:
        due = f"{last.year + last.month // 12:04d}-{last.month % 12 + 1:02d}"
    return due if due <= month_of(now) else None


def months_due(last: date | None, now: date | datetime) -> list[str]:
    """Every month still to load, oldest first."""
    due: list[str] = []
    while month := next_month(last, now):
        due.append(month)
        last = month_start(month)
    return due


def filename_in(path: Column) -> Column:
    """Name of the monthly file inside a path, be it the file or a folder of parts."""
    length = len("2024-01" + FILE_SUFFIX)
    tail = F.substring_index(path, FILE_PREFIX, -1)
    return F.concat(F.lit(FILE_PREFIX), F.left(tail, F.lit(length)))


def following_month(last: Column) -> Column:
    """``yyyy-MM`` of the month after a first-of-month date."""
    return F.date_format(F.add_months(last, 1), "yyyy-MM")
