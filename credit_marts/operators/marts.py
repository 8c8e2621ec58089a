"""Star schema: dimensions with one row per applicant, and the fact they join to one to one.

Every dimension is a group-by of sums, counts and extremes, so Spark combines rows before the
exchange and an applicant with very many rows costs one row per task. Columns named ``*_count``
hold counts; the fact turns them to 0 for an applicant without history and leaves the rest NULL.
Rows without an applicant id belong to nobody and are left to the reference checks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_marts.functions import (
    grant_gap,
    is_delinquent,
    is_late,
    is_missed,
    payment_delay,
    ratio,
    status_severity,
    underpaid,
)

# The outcomes of an earlier application.
PREVIOUS_OUTCOMES = {
    "approved": ("Approved",),
    "refused": ("Refused",),
    "cancelled": ("Cancelled", "Canceled"),
    "unused": ("Unused", "Unused offer"),
}


def _is(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def _snake(value: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in value.lower())


def status_by_credit(
    balance: DataFrame,
    credit: str = "SK_ID_BUREAU",
    status: str = "STATUS",
    **codes: tuple[str, ...],
) -> DataFrame:
    """Monthly statuses per credit: months, worst severity, delinquent months and their share of
    all months. Reduces the largest table before anything is joined to it."""
    severity = status_severity(F.col(status), **codes)
    return (
        balance.where(F.col(credit).isNotNull())
        .groupBy(credit)
        .agg(
            F.count(F.lit(1)).alias("month_count"),
            F.max(severity).alias("worst_status"),
            F.sum(is_delinquent(F.col(status), **codes)).alias("delinquent_month_count"),
        )
        .withColumn("delinquent_share", ratio(F.col("delinquent_month_count"), F.col("month_count")))
    )


def dim_bureau(
    bureau: DataFrame,
    by_credit: DataFrame | None = None,
    applicant: str = "SK_ID_CURR",
    credit: str = "SK_ID_BUREAU",
    active: str = "CREDIT_ACTIVE",
    active_value: str = "Active",
    closed_value: str = "Closed",
    debt: str = "AMT_CREDIT_SUM_DEBT",
    day_overdue: str = "CREDIT_DAY_OVERDUE",
    max_overdue: str = "AMT_CREDIT_MAX_OVERDUE",
    days_credit: str = "DAYS_CREDIT",
) -> DataFrame:
    """External credits per applicant, with the monthly statuses rolled up over both hops."""
    rows = bureau.where(F.col(applicant).isNotNull())
    measures = [
        F.count(F.lit(1)).alias("bureau_count"),
        _is(active, active_value).alias("bureau_active_count"),
        _is(active, closed_value).alias("bureau_closed_count"),
        F.sum(debt).alias("bureau_debt_sum"),
        F.max(day_overdue).alias("bureau_day_overdue_max"),
        F.max(max_overdue).alias("bureau_amt_overdue_max"),
        F.max(days_credit).alias("bureau_days_credit_latest"),
    ]
    if by_credit is None:
        return rows.groupBy(applicant).agg(*measures)
    # Credits without an id have no months; they go around the join, where they would meet in one task.
    months = [F.lit(None).cast(by_credit.schema[c].dataType).alias(c) for c in by_credit.columns if c != credit]
    known = rows.where(F.col(credit).isNotNull()).join(by_credit, credit, "left")
    rows = known.unionByName(rows.where(F.col(credit).isNull()).select("*", *months))
    months = F.sum("month_count")
    delinquent = F.sum("delinquent_month_count")
    return rows.groupBy(applicant).agg(
        *measures,
        F.coalesce(months, F.lit(0)).alias("bureau_month_count"),
        F.max("worst_status").alias("bureau_worst_status"),
        ratio(delinquent, months).alias("bureau_delinquent_share"),
    )


def reason_codes(previous: DataFrame, reason: str = "CODE_REJECT_REASON", most: int = 200) -> list[str]:
    """The reject codes that occur, in order. Each becomes a column, so a column of free text with
    more than ``most`` values is refused."""
    if reason not in previous.columns:
        return []
    codes = previous.where(F.col(reason).isNotNull()).select(reason).distinct().limit(most + 1).collect()
    if len(codes) > most:
        raise ValueError(f"{reason} has more than {most} values")
    return sorted(r[reason] for r in codes)


def dim_previous_application(
    previous: DataFrame,
    applicant: str = "SK_ID_CURR",
    status: str = "NAME_CONTRACT_STATUS",
    reason: str = "CODE_REJECT_REASON",
    applied: str = "AMT_APPLICATION",
    granted: str = "AMT_CREDIT",
    statuses: Mapping[str, Sequence[str]] = PREVIOUS_OUTCOMES,
    reasons: Sequence[str] = (),
) -> DataFrame:
    """Earlier applications per applicant: outcomes, reject reasons and mean grant gap.

    ``statuses`` maps a measure name to the spellings it counts, ``reasons`` lists the codes to
    count; both are fixed lists, so no pass is needed to find the columns.
    """
    return (
        previous.where(F.col(applicant).isNotNull())
        .groupBy(applicant)
        .agg(
            F.count(F.lit(1)).alias("previous_count"),
            *[
                F.count_if(F.col(status).isin(*spellings)).alias(f"previous_{name}_count")
                for name, spellings in statuses.items()
            ],
            *[_is(reason, r).alias(f"previous_reason_{_snake(r)}_count") for r in reasons],
            F.avg(grant_gap(F.col(applied), F.col(granted))).alias("previous_grant_gap_mean"),
        )
    )


def dim_installments_agg(
    payments: DataFrame,
    applicant: str = "SK_ID_CURR",
    due: str = "DAYS_INSTALMENT",
    paid_on: str = "DAYS_ENTRY_PAYMENT",
    prescribed: str = "AMT_INSTALMENT",
    paid: str = "AMT_PAYMENT",
) -> DataFrame:
    """Installments per applicant: missed and late ones, delays, underpaid share, sum paid."""
    delay = payment_delay(F.col(due), F.col(paid_on))
    short = underpaid(F.col(paid), F.col(prescribed))
    return (
        payments.where(F.col(applicant).isNotNull())
        .groupBy(applicant)
        .agg(
            F.count(F.lit(1)).alias("instalment_count"),
            F.count_if(is_missed(F.col(paid))).alias("instalment_missed_count"),
            F.count_if(is_late(F.col(due), F.col(paid_on))).alias("instalment_late_count"),
            F.avg(delay).alias("instalment_delay_mean"),
            F.max(delay).alias("instalment_delay_max"),
            ratio(F.count_if(short), F.count(short)).alias("instalment_underpaid_share"),
            F.sum(paid).alias("instalment_paid_sum"),
        )
    )


def dim_credit_card_agg(
    balance: DataFrame,
    applicant: str = "SK_ID_CURR",
    amount: str = "AMT_BALANCE",
    limit: str = "AMT_CREDIT_LIMIT_ACTUAL",
    atm_drawings: str = "CNT_DRAWINGS_ATM_CURRENT",
    past_due: str = "SK_DPD",
) -> DataFrame:
    """Card months per applicant: utilization, cash drawings, worst days past due."""
    utilization = ratio(F.col(amount), F.col(limit))
    return (
        balance.where(F.col(applicant).isNotNull())
        .groupBy(applicant)
        .agg(
            F.count(F.lit(1)).alias("card_month_count"),
            F.avg(utilization).alias("card_utilization_mean"),
            F.max(utilization).alias("card_utilization_max"),
            F.coalesce(F.sum(atm_drawings), F.lit(0)).cast("bigint").alias("card_atm_drawing_count"),
            F.max(past_due).alias("card_dpd_max"),
        )
    )


def dim_pos_cash_agg(
    balance: DataFrame,
    applicant: str = "SK_ID_CURR",
    status: str = "NAME_CONTRACT_STATUS",
    past_due: str = "SK_DPD",
    past_due_tolerant: str = "SK_DPD_DEF",
    active_value: str = "Active",
    completed_value: str = "Completed",
) -> DataFrame:
    """Point-of-sale and cash loan months per applicant: days past due and contract states."""
    return (
        balance.where(F.col(applicant).isNotNull())
        .groupBy(applicant)
        .agg(
            F.count(F.lit(1)).alias("pos_month_count"),
            F.max(past_due).alias("pos_dpd_max"),
            F.avg(past_due).alias("pos_dpd_mean"),
            F.max(past_due_tolerant).alias("pos_dpd_def_max"),
            F.avg(past_due_tolerant).alias("pos_dpd_def_mean"),
            _is(status, active_value).alias("pos_active_count"),
            _is(status, completed_value).alias("pos_completed_count"),
        )
    )


def fact_application(
    applications: DataFrame, dims: Mapping[str, DataFrame], applicant: str = "SK_ID_CURR"
) -> DataFrame:
    """Applications with all dimensions, one row per application.

    The dimensions are unique on the applicant and already partitioned by it, so the joins run
    one after another without a further exchange. No rows in a dimension means a thin file:
    counts become 0, the other measures stay NULL, ``has_<dimension>_history`` is 0.
    """
    fact = applications
    filled: dict[str, Column] = {}
    for name, dim in dims.items():
        marker = f"has_{name}_history"
        fact = fact.join(dim.withColumn(marker, F.lit(1)), applicant, "left")
        counts = [c for c in dim.columns if c.endswith("_count")] + [marker]
        filled |= {c: F.coalesce(F.col(c), F.lit(0)) for c in counts}
    return fact.withColumns(filled) if filled else fact
