"""SQL expressions for sums and averages that do not depend on partition order.

Whole-number sums stay in ``bigint`` (one codegen'd long add per row) and become
decimals only once per group. Two limits follow from that, both raised by ANSI
mode rather than wrapped: 9.2e16 currency units per group, and 1e16 per mart cell.
"""

from __future__ import annotations


def cents(amount: str) -> str:
    """A DECIMAL(10,2) amount as a whole number of cents."""
    return f"CAST({amount} * 100 AS BIGINT)"


def from_cents(total: str) -> str:
    return f"CAST(CAST({total} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(24,6))"


def rounded(value: str, digits: int) -> str:
    """Round half away from zero to the fixed mart type for this many digits."""
    return f"CAST(round({value}, {digits}) AS DECIMAL(18,{digits}))"


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """``numerator / denominator`` rounded once; NULL for a zero denominator.

    ``avg(decimal)`` would round to six digits first and then again. A DECIMAL(24,6)
    over a DECIMAL(20,0) keeps 20 digits instead, and a quotient that is not itself
    a tie lies further than that from one for any group below 3e12 rows.
    """
    quotient = f"CAST({numerator} AS DECIMAL(24,6)) / CAST(nullif({denominator}, 0) AS DECIMAL(20,0))"
    return rounded(quotient, digits)
