"""Order-independent sums of amounts stored as doubles.

Amounts with a fixed number of digits become whole numbers of their smallest
unit. Adding those up is exact in any order, and several times faster than
adding decimals. A sum past 9.2e18 units is an error, not a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_sql(column: str, digits: int = 2) -> str:
    """SQL text for the amount in its smallest unit."""
    return f"cast(rint(({column}) * {10**digits}) as bigint)"


def amount_sql(units: str, digits: int = 2) -> str:
    """SQL text for a whole number of smallest units as an amount, rounded once."""
    return f"cast(cast({units} as decimal(20,0)) / {10**digits} as double)"


def to_cents(value: Column | str, digits: int = 2) -> Column:
    amount = F.col(value) if isinstance(value, str) else value
    return F.rint(amount * 10**digits).cast("bigint")


def exact_sum(value: Column | str, digits: int = 2) -> Column:
    """The exact sum, as the nearest double: divided as a decimal, as a double holds 53 bits only."""
    return whole_to_amount(F.sum(to_cents(value, digits)), digits)


def whole_to_amount(units: Column, digits: int = 2) -> Column:
    """A whole number of smallest units as an amount, rounded once."""
    return (units.cast("decimal(20,0)") / F.lit(10**digits).cast("decimal(10,0)")).cast("double")
