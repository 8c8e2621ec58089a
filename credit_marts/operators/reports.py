"""Reports read from the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_marts.functions import ratio


def _default_rate(target: str) -> list[Column]:
    """Applications, those with a known outcome, defaults, and defaults per known outcome."""
    defaults = F.count_if(F.col(target) == 1)
    return [
        F.count(F.lit(1)).alias("application_count"),
        F.count(target).alias("labelled_count"),
        defaults.alias("default_count"),
        ratio(defaults, F.count(target)).alias("default_rate"),
    ]


def risk_by_segment(fact: DataFrame, segment: str, target: str = "TARGET") -> DataFrame:
    """Default rate per value of a segment column."""
    return fact.groupBy(segment).agg(*_default_rate(target)).orderBy(segment)


def band(value: Column, edges: Sequence[float]) -> tuple[Column, Column]:
    """Number and label of the band ``[edge, next edge)`` a value is in; NULL has neither."""
    number = F.when(value < edges[0], 0)
    label = F.when(value < edges[0], f"< {edges[0]}")
    for i, (low, high) in enumerate(zip(edges, edges[1:]), start=1):
        number = number.when(value < high, i)
        label = label.when(value < high, f"{low} - {high}")
    return (
        number.when(value.isNotNull(), len(edges)),
        label.when(value.isNotNull(), f">= {edges[-1]}"),
    )


def default_rate_by_band(
    fact: DataFrame, column: str, edges: Sequence[float], target: str = "TARGET"
) -> DataFrame:
    """Default rate per band of a numeric column; ``edges`` ascend."""
    number, label = band(F.col(column), edges)
    return (
        fact.groupBy(number.alias("band"), label.alias("band_label"))
        .agg(*_default_rate(target))
        .orderBy("band")
    )


def applicant_detail(fact: DataFrame, applicant_id: int, applicant: str = "SK_ID_CURR") -> DataFrame:
    """All measures of one application. The filter reaches the scan of a stored fact."""
    return fact.where(F.col(applicant) == applicant_id)
