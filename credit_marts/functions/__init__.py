"""Column expressions. Each takes and returns ``Column`` and stays inside codegen."""

from credit_marts.functions.amounts import grant_gap, half_up_percent, ratio, underpaid
from credit_marts.functions.casts import safe_cast
from credit_marts.functions.days import (
    age_years,
    days_to_years,
    is_late,
    is_missed,
    payment_delay,
)
from credit_marts.functions.status import is_delinquent, status_severity

__all__ = [
    "age_years",
    "days_to_years",
    "grant_gap",
    "half_up_percent",
    "is_delinquent",
    "is_late",
    "is_missed",
    "payment_delay",
    "ratio",
    "safe_cast",
    "status_severity",
    "underpaid",
]
