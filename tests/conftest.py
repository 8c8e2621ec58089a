"""A local session and the hand-made credit tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# Reduced credit tables: name -> (schema, rows).
MINI: dict[str, tuple[str, list[tuple]]] = {
    "application_train": (
        "SK_ID_CURR bigint, TARGET bigint, CODE_GENDER string, NAME_INCOME_TYPE string, OCCUPATION_TYPE string, "
        "DAYS_BIRTH bigint, DAYS_EMPLOYED bigint, AMT_INCOME_TOTAL double, AMT_CREDIT double, EXT_SOURCE_1 double, "
        "EXT_SOURCE_2 double, CNT_CHILDREN bigint",
        [
            (1, 0, "F", "Working", "Laborers", -10000, -1000, 100000.0, 400000.0, 0.5, 0.6, 0),
            (2, 1, "M", "Pensioner", None, -22000, 365243, 50000.0, 150000.0, None, 0.2, 2),
            (3, 0, "F", "Working", None, -15000, -30, 0.0, 90000.0, None, None, 1),
            (3, 0, "F", "Working", None, -15000, -30, 0.0, 90000.0, None, None, 1),
        ],
    ),
    "application_test": (
        "SK_ID_CURR bigint, CODE_GENDER string, NAME_INCOME_TYPE string, OCCUPATION_TYPE string, DAYS_BIRTH bigint, "
        "DAYS_EMPLOYED bigint, AMT_INCOME_TOTAL double, AMT_CREDIT double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, "
        "CNT_CHILDREN bigint",
        [
            (4, "M", "Working", "Drivers", -12000, -200, 80000.0, 80000.0, None, 0.4, 0),
            (5, "XNA", "Student", None, -7000, 365243, 20000.0, 30000.0, 0.1, None, 0),
        ],
    ),
    "bureau": (
        "SK_ID_CURR bigint, SK_ID_BUREAU bigint, CREDIT_ACTIVE string, DAYS_CREDIT bigint, CREDIT_DAY_OVERDUE bigint, "
        "AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_MAX_OVERDUE double",
        [
            (1, 11, "Active", -100, 0, 1000.0, None),
            (1, 12, "Closed", -900, 0, None, None),
            (2, 13, "Active", -50, 30, 5000.0, 70.0),
            (4, 14, "Active", -10, 0, 200.0, None),
            (99, 15, "Closed", -700, 0, 0.0, None),
            (None, 16, "Closed", -5, 0, 0.0, None),
        ],
    ),
    "bureau_balance": (
        "SK_ID_BUREAU bigint, MONTHS_BALANCE bigint, STATUS string",
        [
            (11, -1, "0"),
            (11, -2, "1"),
            (11, -2, "1"),
            (12, -1, "C"),
            (13, -1, "5"),
            (13, -2, "X"),
            (13, None, "0"),
            (98, -1, "0"),
        ],
    ),
    "previous_application": (
        "SK_ID_PREV bigint, SK_ID_CURR bigint, NAME_CONTRACT_STATUS string, AMT_APPLICATION double, "
        "AMT_CREDIT double, DAYS_FIRST_DRAWING double, RATE_INTEREST_PRIMARY double, CODE_REJECT_REASON string",
        [
            (21, 1, "Approved", 1000.0, 900.0, -20.0, None, "XAP"),
            (22, 1, "Refused", 500.0, 0.0, 365243.0, None, "HC"),
            (23, 2, "Approved", 700.0, 700.0, 365243.0, None, "XAP"),
            (24, 97, "Cancelled", 0.0, 0.0, None, None, "XAP"),
        ],
    ),
    "installments_payments": (
        "SK_ID_PREV bigint, SK_ID_CURR bigint, NUM_INSTALMENT_VERSION double, NUM_INSTALMENT_NUMBER bigint, "
        "DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
        [
            (21, 1, 1.0, 1, -100.0, -105.0, 10.0, 10.0),
            (21, 1, 1.0, 2, -70.0, -65.0, 10.0, 6.0),
            (21, 1, 1.0, 2, -70.0, -60.0, 10.0, 4.0),
            (23, 2, 1.0, 1, -40.0, None, 20.0, None),
            (96, 2, 1.0, 1, -30.0, -30.0, 5.0, 5.0),
            (23, 1, 1.0, 2, -10.0, -9.0, 20.0, 20.0),
        ],
    ),
    "credit_card_balance": (
        "SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE bigint, AMT_BALANCE double, "
        "AMT_CREDIT_LIMIT_ACTUAL bigint, AMT_DRAWINGS_ATM_CURRENT double, CNT_DRAWINGS_ATM_CURRENT double, SK_DPD bigint",
        [
            (21, 1, -1, 50.0, 100, None, None, 0),
            (21, 1, -2, 90.0, 100, 20.0, 2.0, 3),
            (23, 2, -1, 10.0, 0, None, None, 0),
        ],
    ),
    "POS_CASH_balance": (
        "SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE bigint, CNT_INSTALMENT double, "
        "NAME_CONTRACT_STATUS string, SK_DPD bigint, SK_DPD_DEF bigint",
        [
            (21, 1, -1, 12.0, "Active", 0, 0),
            (21, 1, -2, None, "Active", 5, 0),
            (23, 2, -1, 6.0, "Completed", 40, 40),
        ],
    ),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("credit-marts-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "work"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mini(spark) -> dict[str, DataFrame]:
    """The hand-made tables."""
    return {name: spark.createDataFrame(rows, schema) for name, (schema, rows) in MINI.items()}


def one(df: DataFrame) -> dict:
    """The only row of a result."""
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def by(df: DataFrame, *keys: str) -> dict:
    """Rows of a result by key."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict() for r in df.collect()}


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
