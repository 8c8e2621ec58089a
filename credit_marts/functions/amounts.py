"""Money and ratio expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal, so that a share is rounded from its exact value and not from a binary fraction.
HUNDRED = Decimal("100.0")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as DOUBLE; NULL when the denominator is zero or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def half_up_percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two decimals, rounded half up; NULL when ``part`` is NULL."""
    share = F.try_divide(F.lit(HUNDRED) * part, whole)
    return F.round(share, 2).cast("double")


def grant_gap(applied: Column, granted: Column) -> Column:
    """Amount asked for minus amount granted; positive when less was granted."""
    return applied - granted


def underpaid(paid: Column, due: Column) -> Column:
    """True when a payment was made and is below the prescribed amount; NULL for a missed one."""
    return paid < due

