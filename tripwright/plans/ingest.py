"""Loading months: write their files, make them the current ones at once, then mark and audit.

Months do not stand or fall together. Each delivery is checked by itself before anything is
written; the sound ones are written in one job, with one scan for each schema that occurs. If that
job fails on a value, the months are written one by one to find the bad ones. All months that were
written become readable in one step. A month that failed keeps the rows it had.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from itertools import takewhile

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tripwright.functions.months import month_start, month_to_filename, months_due, next_month
from tripwright.operators.normalize import raw_rows
from tripwright.schemas import SOURCE_NAME
from tripwright.sources.landing import (
    Delivery,
    deliveries,
    delivered,
    footers,
    month_file,
    scan_files,
)
from tripwright.sources.tables import (
    Store,
    append_audit,
    audit_row,
    commit_files,
    last_loaded_month,
    set_last_loaded_month,
    write_files,
)
from tripwright.sources.versions import Part

log = logging.getLogger(__name__)

Clock = Callable[[], datetime]
#: What reading or writing a month may raise because of its files or values.
FAILURES = (OSError, PySparkException, Py4JJavaError)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class Outcome:
    """What became of a month: rows that were loaded, or an error."""

    month: str
    started_at: datetime
    footers: dict[str, str] | None = None
    mark: str | None = None
    rows: int | None = None
    error: Exception | None = None
    finished_at: datetime | None = None

    @property
    def file(self) -> str:
        return month_to_filename(self.month)

    def fail(self, error: Exception, at: datetime) -> None:
        self.error, self.finished_at = error, at


def _check(
    spark: SparkSession, landing: str, month: str, delivery: Delivery | None, clock: Clock
) -> Outcome:
    """Whether a month was delivered in files that can be read."""
    outcome = Outcome(month, clock())
    try:
        if delivery is None or not delivery.files:
            raise FileNotFoundError(f"[PATH_NOT_FOUND] {landing}/{outcome.file}")
        outcome.mark = delivery.mark
        outcome.footers = footers(spark, delivery)
    except FAILURES as error:
        outcome.fail(error, clock())
    return outcome


def _write(
    spark: SparkSession, store: Store, months: Sequence[Outcome], loaded_at: datetime | None
) -> dict[str, Part]:
    """The files of months, written in one job and not yet current."""
    kinds = {file: kind for month in months for file, kind in month.footers.items()}
    legs = [raw_rows(rows, month_file(), loaded_at) for rows in scan_files(spark, kinds)]
    parts = write_files(reduce(DataFrame.unionAll, legs), store.raw)
    nothing = {"rows": 0, "first_pickup": None, "last_pickup": None, "loaded_at": None}
    return {month.file: parts.get(month.file, Part(None, nothing)) for month in months}


def attempt_months(
    spark: SparkSession,
    store: Store,
    landing: str,
    months: Sequence[str],
    source: str = SOURCE_NAME,
    loaded_at: datetime | None = None,
    clock: Clock = utc_now,
    in_order: bool = False,
) -> list[Outcome]:
    """Load months in the order given and say what became of each.

    Every month gets an audit row of its own: its start is when its delivery was looked at, its
    end when its rows became current or its error was found. The watermark ends at the last month
    before the first that failed, also when that is older than before. ``in_order`` leaves out
    what follows a month that failed.
    """
    months = list(dict.fromkeys(months))
    if not months:
        return []
    there = deliveries(spark, landing, months)
    with ThreadPoolExecutor(8) as pool:  # a footer each
        outcomes = list(
            pool.map(lambda m: _check(spark, landing, m, there.get(m), clock), months)
        )

    def sound() -> list[Outcome]:
        if in_order:
            return list(takewhile(lambda o: o.error is None, outcomes))
        return [o for o in outcomes if o.error is None]

    parts: dict[str, Part] = {}
    good = sound()
    if good:
        try:
            parts = _write(spark, store, good, loaded_at)
        except FAILURES as error:
            if len(good) == 1:
                good[0].fail(error, clock())
            else:
                log.warning("loading %s together failed, going one by one", months)
                for outcome in good:
                    try:
                        parts |= _write(spark, store, [outcome], loaded_at)
                    except FAILURES as own:
                        outcome.fail(own, clock())
                        if in_order:
                            break
    good = sound()
    if good:  # a commit that fails changes nothing, and goes on as it is
        commit_files(spark, store.raw, {o.file: parts[o.file] for o in good})
        at = clock()
        for outcome in good:
            outcome.rows, outcome.finished_at = parts[outcome.file].facts["rows"], at
    before = list(takewhile(lambda o: o.error is None, outcomes))
    if before:
        set_last_loaded_month(spark, store, source, month_start(before[-1].month))
    done = [o for o in outcomes if o.finished_at is not None]
    append_audit(
        spark,
        store,
        [
            audit_row(
                source, o.month, o.file, "error" if o.error else "success",
                o.started_at, o.finished_at, o.rows, str(o.error) if o.error else None,
            )
            for o in done
        ],
    )
    for outcome in done:
        if outcome.error:
            log.error("loading %s failed: %s", outcome.month, outcome.error)
        else:
            log.info("loaded %s: %s rows", outcome.month, outcome.rows)
    return done


def _loaded(outcomes: Sequence[Outcome]) -> list[dict]:
    """The months that were loaded; the first error, if there is one, goes on."""
    for outcome in outcomes:
        if outcome.error:
            outcome.error.add_note(f"while loading {outcome.month}")
            raise outcome.error
    return [{"month": o.month, "rows_loaded": o.rows} for o in outcomes]


def load_months(
    spark: SparkSession, store: Store, landing: str, months: Sequence[str], **options
) -> list[dict]:
    """Load months; loading one again replaces it. An error is raised when the others are in."""
    return _loaded(attempt_months(spark, store, landing, months, **options))


def load_month(spark: SparkSession, store: Store, landing: str, month: str, **options) -> dict:
    return load_months(spark, store, landing, [month], **options)[0]


def load_next(
    spark: SparkSession,
    store: Store,
    landing: str,
    source: str = SOURCE_NAME,
    now: datetime | None = None,
    **options,
) -> dict:
    """Load the month after the watermark, if it is due by ``now``."""
    month = next_month(last_loaded_month(spark, store, source), now or utc_now())
    if month is None:
        return {"skipped": True, "reason": "nothing due"}
    return load_month(spark, store, landing, month, source=source, **options)


def catch_up(
    spark: SparkSession,
    store: Store,
    landing: str,
    source: str = SOURCE_NAME,
    now: datetime | None = None,
    **options,
) -> list[dict]:
    """Load the months due since the watermark that are delivered, up to the first gap.

    Months that nobody delivered yet are waited for. A month that is missing while later ones are
    there, or that cannot be loaded, is an error: it gets an audit row, and is raised after the
    months before it are in.
    """
    due = months_due(last_loaded_month(spark, store, source), now or utc_now())
    there = delivered(spark, landing, due)
    ready = list(takewhile(there.__contains__, due))
    loaded = _loaded(
        attempt_months(spark, store, landing, ready, source=source, in_order=True, **options)
    )
    if len(ready) < len(there):
        gap = due[len(ready)]
        error = FileNotFoundError(f"{gap} is missing, {max(there)} is delivered")
        at = options.get("clock", utc_now)()
        row = audit_row(
            source, gap, month_to_filename(gap), "error", at, at, None, str(error)
        )
        append_audit(spark, store, [row])
        raise error
    return loaded
