"""Day offsets. Times are counted in days before the application, so they are numbers, not dates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: length of a year in days.
DAYS_PER_YEAR = Decimal("365.25")


def days_to_years(days: Column) -> Column:
    """Day count to years. Integral input gives an exact decimal, DOUBLE input a DOUBLE."""
    return days / F.lit(DAYS_PER_YEAR)


def age_years(days_birth: Column) -> Column:
    """Age at application from a negative day offset."""
    return days_to_years(-days_birth)


def payment_delay(due: Column, paid_on: Column) -> Column:
    """Days between due date and payment: positive is late, negative early, NULL missed."""
    return paid_on - due


def is_late(due: Column, paid_on: Column) -> Column:
    """True when paid after the due day; a missed installment is not late but missed."""
    return F.coalesce(paid_on > due, F.lit(False))


def is_missed(payment: Column) -> Column:
    """True when there is no payment."""
    return payment.isNull()
