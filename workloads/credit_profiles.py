"""The forty profiling questions on the credit tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.plans.profiles import profile_query, run_all
from workloads import sql
from workloads.credit_view import CreditTables, with_credit_tables

BOTH = [("application_train", "SK_ID_CURR"), ("application_test", "SK_ID_CURR")]
PREVIOUS = [("previous_application", "SK_ID_PREV")]
BOUNDS = ("min", "max")


def rounded_averages(df: DataFrame, digits: int = 4) -> DataFrame:
    """Averages rounded: a sum of doubles depends on the order in which partitions arrive."""
    return df.select(
        *[F.round(c, digits).alias(c) if c.startswith("avg_") else F.col(c) for c in df.columns]
    )


def _question(table: str, question: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded_averages(
        profile_query(CreditTables(spark, sf_dir), table, question)
    )


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_all(CreditTables(spark, sf_dir)).withColumn("value", F.round("value", 4))


def _application_ranges() -> str:
    age = "round(-DAYS_BIRTH / 365.25, 6)"
    return ", ".join(
        [
            sql.stats("age_years", age),
            sql.sentinel_stats("days_employed", "DAYS_EMPLOYED", 365243),
            sql.stats("income", "AMT_INCOME_TOTAL"),
            sql.stats("credit", "AMT_CREDIT"),
            sql.stats("cnt_children", "CNT_CHILDREN", BOUNDS),
        ]
    )


def _application(table: str) -> dict[str, str]:
    return {
        "keys": sql.key_profile(table, ["SK_ID_CURR"]),
        "null_rates": sql.null_rates(
            table,
            ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "OCCUPATION_TYPE"]
            + ["AMT_ANNUITY", "AMT_GOODS_PRICE", "NAME_TYPE_SUITE"],
        ),
        "ranges": f"SELECT {_application_ranges()} FROM {table}",
        "categories": sql.category_counts(
            table,
            ["CODE_GENDER", "NAME_CONTRACT_TYPE", "NAME_INCOME_TYPE"]
            + ["NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE"],
        ),
    }


def _questions() -> dict[str, dict[str, str]]:
    """Counterpart of each question, per table, over the credit tables."""
    bureau_ranges = ", ".join(
        [
            sql.stats("days_credit", "DAYS_CREDIT"),
            sql.stats("credit_day_overdue", "CREDIT_DAY_OVERDUE", BOUNDS),
            sql.stats("amt_credit_sum", "AMT_CREDIT_SUM"),
        ]
    )
    previous_ranges = ", ".join(
        [
            sql.stats("amt_application", "AMT_APPLICATION", BOUNDS),
            sql.stats("amt_credit", "AMT_CREDIT", BOUNDS),
            sql.stats("days_decision", "DAYS_DECISION", BOUNDS),
            sql.sentinel_stats("days_first_drawing", "DAYS_FIRST_DRAWING", 365243),
        ]
    )
    pos_ranges = ", ".join(
        [
            sql.stats("sk_dpd", "SK_DPD"),
            sql.stats("sk_dpd_def", "SK_DPD_DEF", BOUNDS),
            sql.stats("months_balance", "MONTHS_BALANCE", BOUNDS),
        ]
    )
    card_ranges = ", ".join([sql.stats("amt_balance", "AMT_BALANCE"), sql.stats("sk_dpd", "SK_DPD", BOUNDS)])
    delay = "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT"
    missed = "(count(*) - count(AMT_PAYMENT))"
    month_key = ["SK_ID_PREV", "MONTHS_BALANCE"]
    train = _application("application_train")
    train["class_balance"] = sql.class_balance("application_train", "TARGET")
    return {
        "application_train": train,
        "application_test": _application("application_test"),
        "bureau": {
            "keys": sql.key_profile("bureau", ["SK_ID_BUREAU"]),
            "orphan_sk_id_curr": sql.orphan_count("bureau", "SK_ID_CURR", BOTH),
            "null_rates": sql.null_rates(
                "bureau", ["AMT_CREDIT_SUM_DEBT", "DAYS_CREDIT_ENDDATE", "AMT_CREDIT_MAX_OVERDUE", "AMT_ANNUITY"]
            ),
            "ranges": f"SELECT {bureau_ranges} FROM bureau",
            "categories": sql.category_counts("bureau", ["CREDIT_ACTIVE", "CREDIT_TYPE", "CREDIT_CURRENCY"]),
        },
        "bureau_balance": {
            "keys": sql.key_profile("bureau_balance", ["SK_ID_BUREAU", "MONTHS_BALANCE"]),
            "orphan_sk_id_bureau": sql.orphan_count(
                "bureau_balance", "SK_ID_BUREAU", [("bureau", "SK_ID_BUREAU")]
            ),
            "ranges": f"SELECT {sql.stats('months_balance', 'MONTHS_BALANCE')} FROM bureau_balance",
            "statuses": sql.value_counts("bureau_balance", "STATUS"),
        },
        "previous_application": {
            "keys": sql.key_profile("previous_application", ["SK_ID_PREV"]),
            "orphan_sk_id_curr": sql.orphan_count("previous_application", "SK_ID_CURR", BOTH),
            "null_rates": sql.null_rates(
                "previous_application",
                ["RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "AMT_DOWN_PAYMENT", "AMT_ANNUITY", "CNT_PAYMENT"],
            ),
            "ranges": f"SELECT {previous_ranges} FROM previous_application",
            "categories": sql.category_counts(
                "previous_application", ["NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "CODE_REJECT_REASON"]
            ),
        },
        "credit_card_balance": {
            "keys": sql.key_profile("credit_card_balance", month_key),
            "orphan_sk_id_prev": sql.orphan_count("credit_card_balance", "SK_ID_PREV", PREVIOUS),
            "orphan_sk_id_curr": sql.orphan_count("credit_card_balance", "SK_ID_CURR", BOTH),
            "null_rates": sql.null_rates(
                "credit_card_balance",
                [f"AMT_DRAWINGS_{kind}_CURRENT" for kind in ("ATM", "OTHER", "POS")] + ["AMT_PAYMENT_CURRENT"],
            ),
            "ranges": f"SELECT {card_ranges} FROM credit_card_balance",
            "statuses": sql.value_counts("credit_card_balance", "NAME_CONTRACT_STATUS"),
        },
        "POS_CASH_balance": {
            "keys": sql.key_profile("POS_CASH_balance", month_key),
            "orphan_sk_id_prev": sql.orphan_count("POS_CASH_balance", "SK_ID_PREV", PREVIOUS),
            "orphan_sk_id_curr": sql.orphan_count("POS_CASH_balance", "SK_ID_CURR", BOTH),
            "null_rates": sql.null_rates("POS_CASH_balance", ["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"]),
            "ranges": f"SELECT {pos_ranges} FROM POS_CASH_balance",
            "statuses": sql.value_counts("POS_CASH_balance", "NAME_CONTRACT_STATUS"),
        },
        "installments_payments": {
            "rows": "SELECT count(*) AS row_count FROM installments_payments",
            "orphan_sk_id_prev": sql.orphan_count("installments_payments", "SK_ID_PREV", PREVIOUS),
            "orphan_sk_id_curr": sql.orphan_count("installments_payments", "SK_ID_CURR", BOTH),
            "missing": f"SELECT count(*) AS total_rows, {missed} AS missed_payment_count, "
            f"{sql.percent(missed, 'count(*)')} AS pct_missed_payment, "
            "count(*) - count(DAYS_ENTRY_PAYMENT) AS null_days_entry_payment_count FROM installments_payments",
            "delays": f"SELECT {sql.stats('instalment_number', 'NUM_INSTALMENT_NUMBER', BOUNDS)}, "
            f"{sql.stats('payment_delay_days', delay)}, "
            f"{sql.ones(f'{delay} > 0')} AS late_payment_count "
            "FROM installments_payments WHERE DAYS_ENTRY_PAYMENT IS NOT NULL",
        },
    }


def _metrics_sql() -> str:
    """All single-valued questions as rows."""
    selects = []
    for table, asked in _questions().items():
        single = {q: s for q, s in asked.items() if q not in ("rows", "class_balance", "categories", "statuses")}
        single["total"] = f"SELECT count(*) AS total_rows FROM {table}"
        for question, select in single.items():
            repeated = {"keys": "row_count", "null_rates": "total_rows", "missing": "total_rows"}.get(question)
            wanted = f"* EXCLUDE ({repeated})" if repeated else "*"
            selects.append(
                f"SELECT '{table}' AS table_name, metric, round(value, 4) AS value FROM "
                f"(SELECT CAST(COLUMNS({wanted}) AS DOUBLE) FROM ({select})) "
                "UNPIVOT INCLUDE NULLS (value FOR metric IN (COLUMNS(*)))"
            )
    return " UNION ALL ".join(selects)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    asked = [(table, question) for table, found in _questions().items() for question in found]
    return {f"{t}_{q}": _question(t, q) for t, q in asked} | {"credit_metrics": _metrics}


def oracle_sql() -> dict[str, str]:
    selects = {f"{t}_{q}": select for t, found in _questions().items() for q, select in found.items()}
    selects["credit_metrics"] = _metrics_sql()
    return {name: with_credit_tables(select) for name, select in selects.items()}
