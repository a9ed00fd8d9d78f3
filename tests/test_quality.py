from datetime import datetime, timedelta

import pytest

from tripwright.operators.quality import (
    Check,
    accepted_values,
    between,
    duplicates,
    freshness,
    not_null,
    report,
    unique,
    violations,
)
from tripwright.plans.checks import DAILY_CHECKS, STAGING_CHECKS, TRENDS_CHECKS, ZONE_CHECKS

CHECKS = [
    not_null("k"),
    unique("k"),
    accepted_values("label", ("x", "y")),
    between("v", 0, 10),
    between("v", 0, 10, strictly=True),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "x", 0.0), (1, "y", 5.0), (1, "z", 10.0), (2, None, 11.0), (None, "x", None), (None, "q", -1.0)],
        "k int, label string, v double",
    )


def as_dict(result):
    return {(r.column_name, r.check_name, i): r.failures for i, r in enumerate(result.collect())}


def test_report_counts_failures(rows):
    result = report(rows, "some_model", CHECKS)
    assert result.columns == ["model", "column_name", "check_name", "failures"]
    assert [(r.model, r.column_name, r.check_name, r.failures) for r in result.collect()] == [
        ("some_model", "k", "not_null", 2),
        ("some_model", "k", "unique", 1),  # one repeated key; NULLs are no key
        ("some_model", "label", "accepted_values", 2),  # NULL passes
        ("some_model", "v", "between", 2),
        ("some_model", "v", "between", 4),
    ]


def test_report_without_a_key_agrees(rows):
    checks = [c for c in CHECKS if c.name != "unique"]
    assert [r.failures for r in report(rows, "m", checks).collect()] == [2, 2, 2, 4]


def test_report_on_several_keys(rows):
    checks = [unique("k"), not_null("k"), unique("label"), unique("v")]
    got = {(r.column_name, r.check_name): r.failures for r in report(rows, "m", checks).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 2, ("label", "unique"): 1, ("v", "unique"): 0}


def test_empty_table_passes(rows):
    assert [r.failures for r in report(rows.limit(0), "m", CHECKS).collect()] == [0] * 5


def test_passing_rows(spark):
    rows = spark.createDataFrame([(1, "x", 1.0), (2, "y", 9.0)], "k int, label string, v double")
    assert [r.failures for r in report(rows, "m", CHECKS).collect()] == [0] * 5
    assert violations(rows, [c for c in CHECKS if c.name != "unique"]).count() == 0
    assert duplicates(rows, "k").count() == 0


def test_violations_name_the_check(rows):
    checks = [not_null("k"), accepted_values("label", ("x", "y")), between("v", 0, 10, strictly=True)]
    result = violations(rows, checks)
    assert result.columns == ["column_name", "check_name", "k", "label", "v"]
    got = sorted(((r.column_name, r.label, r.v) for r in result.collect()), key=str)
    assert got == sorted(
        [
            ("k", "x", None), ("k", "q", -1.0), ("label", "z", 10.0), ("label", "q", -1.0),
            ("v", "x", 0.0), ("v", "z", 10.0), ("v", None, 11.0), ("v", "q", -1.0),
        ],
        key=str,
    )


def test_duplicates(rows):
    assert [tuple(r) for r in duplicates(rows, "k").collect()] == [(1, 3)]


def test_unknown_check_is_refused():
    with pytest.raises(ValueError):
        Check("k", "no_such_check").fails()


@pytest.mark.parametrize(
    "age, status",
    [
        (timedelta(0), "pass"),
        (timedelta(days=1), "pass"),
        (timedelta(days=1, seconds=1), "warn"),
        (timedelta(days=2), "warn"),
        (timedelta(days=2, seconds=1), "error"),
    ],
)
def test_freshness(spark, age, status):
    newest = datetime(2024, 2, 1, 12)
    df = spark.createDataFrame([(newest,), (datetime(2024, 1, 1),), (None,)], "loaded_at timestamp_ntz")
    row = freshness(df, "loaded_at", [newest + age]).first()
    assert (row.max_loaded_at, row.status) == (newest, status)
    assert row.age_seconds == age.total_seconds()


def test_nothing_loaded_is_an_error(spark):
    df = spark.createDataFrame([], "loaded_at timestamp_ntz")
    assert freshness(df, "loaded_at", [datetime(2024, 1, 1)]).first().status == "error"


def test_declared_checks():
    uses = STAGING_CHECKS + DAILY_CHECKS + ZONE_CHECKS + TRENDS_CHECKS
    kinds = [check.name for check in uses]
    assert len(uses) == 28
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 19, "unique": 3, "accepted_values": 2, "between": 4,
    }
