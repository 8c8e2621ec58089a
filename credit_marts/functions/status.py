"""Monthly credit status codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# C closed, 0 nothing past due, 1..5 buckets of days past due, X unknown.
CLEAN_STATUSES = ("C", "0")
PAST_DUE_STATUSES = ("1", "2", "3", "4", "5")


def status_severity(
    status: Column,
    clean: tuple[str, ...] = CLEAN_STATUSES,
    past_due: tuple[str, ...] = PAST_DUE_STATUSES,
) -> Column:
    """0 for a clean month, the rank of the past-due bucket otherwise, NULL when unknown."""
    severity = F.when(status.isin(*clean), 0)
    for rank, code in enumerate(past_due, start=1):
        severity = severity.when(status == code, rank)
    return severity


def is_delinquent(status: Column, **codes: tuple[str, ...]) -> Column:
    """1 when the month is in a past-due bucket, else 0 (unknown months count as 0)."""
    return (F.coalesce(status_severity(status, **codes), F.lit(0)) >= 1).cast("int")
