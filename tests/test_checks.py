"""Quality checks."""

import pytest
from conftest import by, one

from credit_marts.operators import checks
from credit_marts.operators.profile import Measure
from credit_marts.plans import LINKS


def test_expectations(mini):
    rules = [
        checks.not_null("SK_ID_CURR"),
        checks.in_range("CREDIT_DAY_OVERDUE", 0, 20),
        checks.in_range("AMT_CREDIT_SUM_DEBT", high=999),
        checks.in_set("CREDIT_ACTIVE", ["Closed"]),
    ]
    found = by(checks.expectations(mini["bureau"], rules), "rule")
    assert {k: r["failed_count"] for k, r in found.items()} == {
        "not_null(SK_ID_CURR)": 1, "in_range(CREDIT_DAY_OVERDUE, 0..20)": 1, "in_range(AMT_CREDIT_SUM_DEBT, ..999)": 2,
        "in_set(CREDIT_ACTIVE)": 3,
    }
    assert {r["total_rows"] for r in found.values()} == {6}
    with pytest.raises(checks.CheckFailed, match="CREDIT_ACTIVE.: 3 rows"):
        checks.enforce(mini["bureau"], rules)
    checks.enforce(mini["bureau"], [checks.not_null("SK_ID_BUREAU")])
    checks.enforce(mini["bureau"], [])


def test_null_passes_range_and_set(mini):
    rules = [checks.in_range("AMT_CREDIT_MAX_OVERDUE", 70, 70), checks.in_set("AMT_CREDIT_MAX_OVERDUE", [70.0])]
    checks.enforce(mini["bureau"], rules)


def test_unique(mini):
    keys = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "NUM_INSTALMENT_VERSION"]
    row = one(checks.unique_check(mini["installments_payments"], keys))
    assert (row["duplicate_key_combo"], row["is_unique"]) == (1, False)
    checks.enforce_unique(mini["bureau"], ["SK_ID_BUREAU"])
    with pytest.raises(checks.CheckFailed):
        checks.enforce_unique(mini["application_train"], ["SK_ID_CURR"])


def test_fk_report(mini):
    found = by(checks.fk_report(mini, LINKS), "child", "key")
    assert {k: (r["orphan_count"], r["orphan_keys"]) for k, r in found.items() if r["orphan_count"]} == {
        ("bureau", "SK_ID_CURR"): (2, 1),
        ("bureau_balance", "SK_ID_BUREAU"): (1, 1),
        ("previous_application", "SK_ID_CURR"): (1, 1),
        ("installments_payments", "SK_ID_PREV"): (1, 1),
    }
    assert len(found) == 9
    with pytest.raises(checks.CheckFailed, match="bureau.SK_ID_CURR: 2 rows"):
        checks.enforce_fk(mini, LINKS)
    checks.enforce_fk(mini, [link for link in LINKS if link.child == "POS_CASH_balance"])


def test_path_agreement(mini):
    found = checks.path_agreement(
        mini["installments_payments"], mini["previous_application"], "SK_ID_PREV", "SK_ID_CURR"
    )
    assert one(found) == {"compared_count": 5, "disagreement_count": 1}
    for table in ("POS_CASH_balance", "credit_card_balance"):
        found = checks.path_agreement(mini[table], mini["previous_application"], "SK_ID_PREV", "SK_ID_CURR")
        assert one(found) == {"compared_count": 3, "disagreement_count": 0}


def test_path_agreement_with_nulls(spark):
    child = spark.createDataFrame([(1, None), (1, 5), (2, None), (None, 5)], "k bigint, o bigint")
    bridge = spark.createDataFrame([(1, 5), (2, None)], "k bigint, o bigint")
    assert one(checks.path_agreement(child, bridge, "k", "o")) == {"compared_count": 3, "disagreement_count": 1}


def test_category_drift(mini):
    columns = ["NAME_INCOME_TYPE", "CODE_GENDER"]
    found = by(checks.category_drift(mini["application_train"], mini["application_test"], columns), "column_name", "value")
    assert {k: (r["train_count"], r["test_count"]) for k, r in found.items()} == {
        ("NAME_INCOME_TYPE", "Student"): (0, 1), ("NAME_INCOME_TYPE", "Pensioner"): (1, 0),
        ("CODE_GENDER", "F"): (3, 0), ("CODE_GENDER", "XNA"): (0, 1),
    }


def test_profile_drift(mini):
    found = by(
        checks.profile_drift(
            mini["application_train"], mini["application_test"], ["EXT_SOURCE_1"], [Measure("income", "AMT_INCOME_TOTAL")]
        ),
        "metric",
    )
    assert {k: (r["train_value"], r["test_value"], r["delta"]) for k, r in found.items()} == {
        "pct_null_ext_source_1": (75.0, 50.0, -25.0), "min_income": (0.0, 20000.0, 20000.0),
        "max_income": (100000.0, 80000.0, -20000.0), "avg_income": (37500.0, 50000.0, 12500.0),
    }


def test_row_preservation(mini):
    base = mini["application_test"]
    assert one(checks.row_preservation(base, base, "SK_ID_CURR"))["is_preserved"]
    doubled = one(checks.row_preservation(base.unionAll(base), base, "SK_ID_CURR"))
    assert (doubled["is_preserved"], doubled["fact_rows"], doubled["base_rows"]) == (False, 4, 2)


def test_reconcile_counts(mini):
    assert one(checks.reconcile_counts(mini["bureau"], mini["bureau"])) == {
        "source_rows": 6, "target_rows": 6, "is_equal": True,
    }
    assert one(checks.reconcile_counts(5, mini["bureau"]))["is_equal"] is False
