"""Column helpers: everything stays inside built-in, code-generated expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawdown.model import AMOUNT, RATE, UNITS_PER_CREDIT

__all__ = [
    "as_date",
    "avg_exact",
    "count_where",
    "from_units",
    "month_number",
    "month_of",
    "month_start",
    "null_greatest",
    "null_least",
    "ratio",
    "round_half_up",
    "sum_amount",
    "sum_where",
    "to_units",
    "true_if",
    "utc_clock",
    "utc_instant",
]

_MONEY_DIGITS = T.DecimalType(28, 6)
_RATE_DIGITS = T.DecimalType(28, 8)


def as_date(value: date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def month_number(day: Column) -> Column:
    """Months since year 0: a join and grouping key cheaper than a date."""
    return F.year(day) * 12 + F.month(day) - 1


def month_start(number: Column) -> Column:
    return F.make_date(F.floor(number / 12).cast("int"), number % 12 + 1, F.lit(1))


def null_least(a: Column, b: Column) -> Column:
    """Smaller of two values, NULL when either is NULL (``least`` skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def null_greatest(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_up(value: Column, places: int) -> Column:
    """Round half away from zero, decided on six decimal digits (eight for rates).

    Going through a decimal keeps the result independent of how a binary
    double happens to sit around a tie.
    """
    digits = _MONEY_DIGITS if places <= 2 else _RATE_DIGITS
    return F.round(value.cast(digits), places).cast("double")


def sum_amount(value: Column) -> Column:
    """Order-independent sum of money, returned as double."""
    return F.sum(value.cast(AMOUNT)).cast("double")


def to_units(credits: Column) -> Column:
    """Credits as whole ten-thousandths: exact, and summed as plain longs."""
    return F.rint(credits * UNITS_PER_CREDIT).cast("long")


def from_units(units: Column) -> Column:
    return units / F.lit(float(UNITS_PER_CREDIT))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum over the rows that meet a condition, zero when none does."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def avg_exact(rate: Column, kind: T.DecimalType = RATE) -> Column:
    """Mean of rates from an exact decimal sum, to twelve digits.

    The same in any order of rows, and an average of exactly 0.8 stays 0.8.
    """
    mean = F.sum(rate.cast(kind)).cast("double") / F.nullif(F.count(rate), F.lit(0))
    return mean.cast(kind).cast("double")


def true_if(condition: Column) -> Column:
    """TRUE when the condition holds, FALSE when it is false or unknown."""
    return F.coalesce(condition, F.lit(False))


def utc_instant(clock: Column) -> Column:
    """Instant of a zone-free clock reading taken as UTC, whatever the session zone."""
    return F.timestamp_seconds(F.lit(0)) + (clock - F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def utc_clock(instant: Column) -> Column:
    """UTC clock reading of an instant, whatever the session zone."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + (
        instant - F.timestamp_seconds(F.lit(0))
    )
