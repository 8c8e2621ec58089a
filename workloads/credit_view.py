"""The eight credit tables, derived from the test tables by projection (and one join).

The expressions are the input of both sides of a comparison, so they are written once, in the
SQL that Spark and DuckDB share; only the day difference differs and is passed in.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.plans.lazy import LazyTables

Days = Callable[[str, str], str]


def spark_days(timestamp: str, origin: str) -> str:
    return f"datediff(CAST({timestamp} AS DATE), DATE '{origin}')"


def duckdb_days(timestamp: str, origin: str) -> str:
    return f"date_diff('day', DATE '{origin}', CAST({timestamp} AS DATE))"


def _application(with_target: bool) -> dict[str, str]:
    target = {"TARGET": "CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT)"}
    return {
        "SK_ID_CURR": "CASE WHEN c_custkey % 40 = 39 THEN c_custkey - 1 ELSE c_custkey END",
        **(target if with_target else {}),
        "CODE_GENDER": "CASE WHEN c_nationkey < 12 THEN 'F' WHEN c_nationkey < 24 THEN 'M' ELSE 'XNA' END",
        "NAME_CONTRACT_TYPE": "CASE WHEN c_acctbal > 9000 THEN 'Revolving loans' ELSE 'Cash loans' END",
        "NAME_INCOME_TYPE": "CASE WHEN c_nationkey >= 20 THEN 'Pensioner' ELSE c_mktsegment END",
        "NAME_EDUCATION_TYPE": "CASE WHEN c_nationkey < 5 THEN 'Higher' WHEN c_nationkey < 20 THEN 'Secondary' END",
        "NAME_FAMILY_STATUS": "CASE WHEN c_acctbal > 3000 THEN 'Married' ELSE 'Single' END",
        "NAME_HOUSING_TYPE": "CASE WHEN c_nationkey = 11 THEN 'With parents' ELSE 'House' END",
        "NAME_TYPE_SUITE": "NULLIF(c_mktsegment, 'MACHINERY')",
        "OCCUPATION_TYPE": "CASE WHEN c_nationkey < 6 THEN 'Laborers' WHEN c_acctbal > 2000 THEN 'Drivers' END",
        "CNT_CHILDREN": "CAST(FLOOR(c_nationkey / 8) AS BIGINT)",
        "AMT_INCOME_TOTAL": "CAST(CASE WHEN c_nationkey = 7 THEN 0 ELSE ABS(c_acctbal) + 1000 END AS DOUBLE)",
        "AMT_CREDIT": "CAST(3 * ABS(c_acctbal) + 500 AS DOUBLE)",
        "AMT_ANNUITY": "CAST(CASE WHEN c_acctbal > 100 THEN c_acctbal / 20 END AS DOUBLE)",
        "AMT_GOODS_PRICE": "CAST(CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS DOUBLE)",
        "DAYS_BIRTH": "CAST(-(7500 + 700 * c_nationkey) AS BIGINT)",
        "DAYS_EMPLOYED": "CAST(CASE WHEN c_nationkey >= 20 THEN 365243 ELSE -(30 * c_nationkey + 10) END AS BIGINT)",
        "EXT_SOURCE_1": "CAST(CASE WHEN c_acctbal > 4000 THEN c_acctbal / 10000 END AS DOUBLE)",
        "EXT_SOURCE_2": "CAST(CASE WHEN c_acctbal > -500 THEN c_acctbal / 20000 END AS DOUBLE)",
        "EXT_SOURCE_3": "CAST(CASE WHEN c_nationkey < 19 THEN c_acctbal / 30000 END AS DOUBLE)",
        "APARTMENTS_AVG": "CAST(CASE WHEN c_nationkey < 10 THEN c_acctbal / 10000 END AS DOUBLE)",
        "LIVINGAREA_AVG": "CAST(CASE WHEN c_nationkey < 15 THEN c_acctbal / 5000 END AS DOUBLE)",
        "ELEVATORS_AVG": "CAST(CASE WHEN c_nationkey > 4 THEN 0.5 END AS DOUBLE)",
        "APARTMENTS_MODE": "CAST(CASE WHEN c_nationkey < 8 THEN c_acctbal / 5000 END AS DOUBLE)",
        "LIVINGAREA_MEDI": "CAST(CASE WHEN c_nationkey > 12 THEN 0.25 END AS DOUBLE)",
    }


def columns(days: Days) -> dict[str, tuple[str, str | None, dict[str, str]]]:
    """Per credit table: the test table(s) it reads, a row condition, and its columns."""
    decided = days("o_orderdate", "2001-08-02")
    due, shipped = days("o_orderdate", "2001-12-31"), days("l_shipdate", "2001-12-31")
    paid = "(l_returnflag <> 'N' OR l_linestatus = 'F')"
    contract = "CASE WHEN l_linestatus = 'O' THEN 'Active' WHEN l_returnflag = 'N' THEN 'Signed' ELSE 'Completed' END"
    drawn = "CASE WHEN l_returnflag = 'R' THEN {} END"
    return {
        "application_train": ("customer", "c_mktsegment <> 'BUILDING'", _application(True)),
        "application_test": ("customer", "c_mktsegment = 'BUILDING'", _application(False)),
        "bureau": (
            "events",
            None,
            {
                "SK_ID_CURR": "CASE WHEN value > 250 THEN -1 - user_id ELSE NULLIF(user_id, 0) END",
                "SK_ID_BUREAU": "CASE WHEN event_id % 40 = 39 THEN event_id - 1 ELSE event_id END",
                "CREDIT_ACTIVE": "CASE WHEN event_type IN ('purchase', 'view') THEN 'Active' "
                "WHEN event_type = 'error' THEN 'Sold' ELSE 'Closed' END",
                "CREDIT_CURRENCY": "CASE WHEN value < 10 THEN 'currency 2' ELSE 'currency 1' END",
                "CREDIT_TYPE": "event_type",
                "DAYS_CREDIT": f"CAST({days('ts', '2024-02-01')} AS BIGINT)",
                "CREDIT_DAY_OVERDUE": "CAST(CASE WHEN event_type = 'error' THEN FLOOR(value) ELSE 0 END AS BIGINT)",
                "DAYS_CREDIT_ENDDATE": "CAST(CASE WHEN event_type <> 'signup' THEN FLOOR(value) + "
                "CASE WHEN value < 1 THEN 0.5 ELSE 0 END END AS DOUBLE)",
                "AMT_CREDIT_MAX_OVERDUE": "CAST(CASE WHEN event_type = 'error' THEN value END AS DOUBLE)",
                "AMT_CREDIT_SUM": "CAST(value * 100 AS DOUBLE)",
                "AMT_CREDIT_SUM_DEBT": "CAST(CASE WHEN event_type <> 'click' THEN value * 50 END AS DOUBLE)",
                "AMT_ANNUITY": "CAST(CASE WHEN value > 20 THEN value / 16 END AS DOUBLE)",
            },
        ),
        "bureau_balance": (
            "lineitem",
            None,
            {
                "SK_ID_BUREAU": "l_orderkey",
                "MONTHS_BALANCE": "CAST(-NULLIF(l_linenumber, 7) AS BIGINT)",
                "STATUS": "CASE WHEN l_returnflag = 'A' THEN 'C' WHEN l_returnflag = 'N' THEN '0' "
                "WHEN l_linestatus = 'F' THEN 'X' WHEN l_quantity < 20 THEN '1' WHEN l_quantity < 30 THEN '2' "
                "WHEN l_quantity < 40 THEN '3' WHEN l_quantity < 48 THEN '4' ELSE '5' END",
            },
        ),
        "previous_application": (
            "orders",
            None,
            {
                "SK_ID_PREV": "CASE WHEN o_orderkey % 40 = 39 THEN o_orderkey - 1 ELSE o_orderkey END",
                "SK_ID_CURR": "CASE WHEN o_totalprice > 495000 THEN -1 - o_custkey ELSE o_custkey END",
                "NAME_CONTRACT_TYPE": "CASE WHEN o_totalprice < 100000 THEN 'Consumer loans' ELSE 'Cash loans' END",
                "NAME_CONTRACT_STATUS": "CASE WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'O' "
                "THEN 'Refused' WHEN o_orderpriority = '5-LOW' THEN 'Unused offer' ELSE 'Canceled' END",
                "CODE_REJECT_REASON": "CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE 'XAP' END",
                "AMT_APPLICATION": "o_totalprice",
                "AMT_CREDIT": "CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice - 1000 "
                "WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END AS DOUBLE)",
                "AMT_DOWN_PAYMENT": "CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 8 END AS DOUBLE)",
                "AMT_ANNUITY": "CAST(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 16 END AS DOUBLE)",
                "CNT_PAYMENT": "CAST(CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 12 END AS DOUBLE)",
                "DAYS_DECISION": f"CAST({decided} AS BIGINT)",
                "DAYS_FIRST_DRAWING": f"CAST(CASE WHEN o_orderstatus = 'O' THEN 365243 "
                f"WHEN o_orderstatus = 'F' THEN {decided} END AS DOUBLE)",
                "RATE_INTEREST_PRIMARY": "CAST(CASE WHEN o_totalprice > 490000 THEN 0.1875 END AS DOUBLE)",
                "RATE_INTEREST_PRIVILEGED": "CAST(CASE WHEN o_totalprice < 5000 THEN 0.75 END AS DOUBLE)",
            },
        ),
        "POS_CASH_balance": (
            "lineitem",
            None,
            {
                "SK_ID_PREV": "l_partkey",
                "SK_ID_CURR": "l_suppkey",
                "MONTHS_BALANCE": "CAST(-l_linenumber AS BIGINT)",
                "CNT_INSTALMENT": "CAST(NULLIF(l_quantity, 50) AS DOUBLE)",
                "CNT_INSTALMENT_FUTURE": "CAST(CASE WHEN l_returnflag <> 'A' THEN l_quantity - 1 END AS DOUBLE)",
                "NAME_CONTRACT_STATUS": contract,
                "SK_DPD": "CAST(CASE WHEN l_returnflag = 'A' THEN FLOOR(l_quantity) ELSE 0 END AS BIGINT)",
                "SK_DPD_DEF": "CAST(CASE WHEN l_returnflag = 'A' AND l_quantity > 40 THEN 5 ELSE 0 END AS BIGINT)",
            },
        ),
        "credit_card_balance": (
            "lineitem",
            None,
            {
                "SK_ID_PREV": "l_orderkey",
                "SK_ID_CURR": "CASE WHEN l_quantity = 13 THEN NULL ELSE l_suppkey END",
                "MONTHS_BALANCE": "CAST(-l_linenumber AS BIGINT)",
                "AMT_BALANCE": "l_extendedprice",
                "AMT_CREDIT_LIMIT_ACTUAL": "CAST(CASE WHEN l_quantity < 5 THEN 0 ELSE 4500 * FLOOR(l_quantity) END AS BIGINT)",
                "AMT_DRAWINGS_ATM_CURRENT": f"CAST({drawn.format('l_extendedprice / 2')} AS DOUBLE)",
                "AMT_DRAWINGS_OTHER_CURRENT": f"CAST({drawn.format('l_extendedprice / 4')} AS DOUBLE)",
                "AMT_DRAWINGS_POS_CURRENT": f"CAST({drawn.format('l_extendedprice / 8')} AS DOUBLE)",
                "AMT_PAYMENT_CURRENT": "CAST(CASE WHEN l_linestatus = 'F' THEN l_extendedprice / 16 END AS DOUBLE)",
                "CNT_DRAWINGS_ATM_CURRENT": f"CAST({drawn.format('l_linenumber')} AS DOUBLE)",
                "NAME_CONTRACT_STATUS": contract,
                "SK_DPD": "CAST(CASE WHEN l_returnflag = 'N' THEN FLOOR(l_quantity) ELSE 0 END AS BIGINT)",
                "SK_DPD_DEF": "CAST(CASE WHEN l_returnflag = 'N' AND l_quantity > 45 THEN 9 ELSE 0 END AS BIGINT)",
            },
        ),
        "installments_payments": (
            "lineitem JOIN orders",
            None,
            {
                "SK_ID_PREV": "CASE WHEN l_quantity = 1 AND l_linestatus = 'F' THEN -1 - l_orderkey ELSE l_orderkey END",
                "SK_ID_CURR": "CASE WHEN l_tax = 0 AND l_quantity > 45 THEN -1 - l_suppkey "
                "WHEN l_tax = 0 THEN l_suppkey ELSE o_custkey END",
                "NUM_INSTALMENT_VERSION": "CAST(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS DOUBLE)",
                "NUM_INSTALMENT_NUMBER": "CAST(l_linenumber AS BIGINT)",
                "DAYS_INSTALMENT": f"CAST({due} AS DOUBLE)",
                "DAYS_ENTRY_PAYMENT": f"CAST(CASE WHEN {paid} THEN {shipped} END AS DOUBLE)",
                "AMT_INSTALMENT": "l_extendedprice",
                "AMT_PAYMENT": f"CAST(CASE WHEN {paid} THEN l_extendedprice * (1 - l_discount) END AS DOUBLE)",
            },
        ),
    }


class CreditTables(LazyTables):
    """The credit tables as DataFrames, each read when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        def read(name: str) -> DataFrame:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")

        def derive(source: str, condition: str | None, exprs: dict[str, str]) -> DataFrame:
            if " JOIN " in source:
                df = read("lineitem").join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            else:
                df = read(source)
            df = df.where(condition) if condition else df
            return df.selectExpr(*[f"{e} AS {n}" for n, e in exprs.items()])

        defined = columns(spark_days)
        super().__init__({name: partial(derive, *definition) for name, definition in defined.items()})


def with_credit_tables(select: str) -> str:
    """DuckDB query with the definitions of the credit tables it mentions in front."""
    parts = []
    for name, (source, condition, exprs) in columns(duckdb_days).items():
        if not re.search(rf"\b{name}\b", select):
            continue
        on = " ON l_orderkey = o_orderkey" if " JOIN " in source else ""
        where = f" WHERE {condition}" if condition else ""
        listed = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
        parts.append(f"{name} AS (SELECT {listed} FROM {source}{on}{where})")
    return "WITH " + ",\n".join(parts) + "\n" + select
