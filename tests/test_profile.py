"""Profiling on the hand-made tables, on empty ones, and under skew."""

import pytest
from conftest import MINI, by, one
from pyspark.sql import functions as F

from credit_marts.operators import profile as p
from credit_marts.plans import profile_query, profiles, run_all, table_questions
from credit_marts.plans.profiles import LINKS


def parents(mini, *names, key):
    return [p.Parent(mini[n], key) for n in names]


APPLICATIONS = ("application_train", "application_test")


def test_single_key(mini):
    assert one(p.key_profile(mini["application_train"], ["SK_ID_CURR"])) == {
        "row_count": 4, "distinct_sk_id_curr": 3, "duplicate_sk_id_curr": 1,
    }


def test_single_key_counts_nulls_as_duplicates(mini):
    assert one(p.key_profile(mini["bureau"], ["SK_ID_CURR"])) == {
        "row_count": 6, "distinct_sk_id_curr": 4, "duplicate_sk_id_curr": 2,
    }


def test_composite_key(mini):
    assert one(p.key_profile(mini["bureau_balance"], ["SK_ID_BUREAU", "MONTHS_BALANCE"])) == {
        "row_count": 8, "distinct_sk_id_bureau": 4, "distinct_key_combo": 6, "duplicate_key_combo": 2,
    }


def test_three_column_key_with_another_lead(mini):
    keys = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "NUM_INSTALMENT_VERSION"]
    assert one(p.key_profile(mini["installments_payments"], keys, lead="NUM_INSTALMENT_NUMBER")) == {
        "row_count": 6, "distinct_num_instalment_number": 2, "distinct_key_combo": 5, "duplicate_key_combo": 1,
    }


def test_class_balance(mini):
    rows = p.class_balance(mini["application_train"], "TARGET").collect()
    assert [tuple(r) for r in rows] == [(0, 3, 75.0), (1, 1, 25.0)]


def test_class_balance_keeps_null_first(mini):
    rows = p.class_balance(mini["application_train"], "OCCUPATION_TYPE").collect()
    assert [tuple(r) for r in rows] == [(None, 3, 75.0), ("Laborers", 1, 25.0)]


def test_percent_is_rounded_half_up_from_the_exact_value(spark):
    df = spark.range(800).select(F.when(F.col("id") > 0, F.col("id")).alias("v"))
    assert one(p.null_rates(df, ["v"]))["pct_null_v"] == 0.13  # 0.125
    df = spark.range(20000).select(F.when(F.col("id") >= 201, F.col("id")).alias("v"))
    assert one(p.null_rates(df, ["v"]))["pct_null_v"] == 1.01  # 1.005


def test_null_rates(mini):
    columns = ["EXT_SOURCE_1", "EXT_SOURCE_2", "OCCUPATION_TYPE"]
    assert one(p.null_rates(mini["application_train"], columns)) == {
        "total_rows": 4, "pct_null_ext_source_1": 75.0, "pct_null_ext_source_2": 50.0, "pct_null_occupation_type": 75.0,
    }
    assert one(p.null_rates(mini["POS_CASH_balance"], ["CNT_INSTALMENT"]))["pct_null_cnt_instalment"] == 33.33


def test_application_ranges(mini):
    row = one(p.range_stats(mini["application_train"], profiles()["application_train"].measures))
    assert row["min_age_years"] == 27.378508
    assert row["max_age_years"] == 60.232717
    assert round(row["avg_age_years"], 4) == 42.4367
    assert row["days_employed_sentinel_count"] == 1
    assert (row["min_days_employed_excl_sentinel"], row["max_days_employed_excl_sentinel"]) == (-1000, -30)
    assert (row["min_income"], row["max_income"], row["avg_income"]) == (0.0, 100000.0, 37500.0)
    assert (row["min_cnt_children"], row["max_cnt_children"]) == (0, 2)


def test_sentinel_with_nulls(mini):
    measures = [m for m in profiles()["previous_application"].measures if m.sentinel]
    assert one(p.range_stats(mini["previous_application"], measures)) == {
        "days_first_drawing_sentinel_count": 2,
        "min_days_first_drawing_excl_sentinel": -20.0,
        "max_days_first_drawing_excl_sentinel": -20.0,
    }


def test_value_counts_are_ordered(mini):
    rows = p.value_counts(mini["bureau_balance"], "STATUS").collect()
    assert [tuple(r) for r in rows] == [("0", 3), ("1", 2), ("5", 1), ("C", 1), ("X", 1)]


@pytest.mark.parametrize("one_pass", [False, True])
def test_category_counts_of_text_and_numbers(mini, one_pass):
    columns = ["CODE_GENDER", "CNT_CHILDREN", "OCCUPATION_TYPE"]
    rows = p.category_counts(mini["application_train"], columns, one_pass=one_pass).collect()
    assert [tuple(r) for r in rows] == [
        ("CNT_CHILDREN", "0", 1), ("CNT_CHILDREN", "1", 2), ("CNT_CHILDREN", "2", 1),
        ("CODE_GENDER", "F", 3), ("CODE_GENDER", "M", 1),
        ("OCCUPATION_TYPE", None, 3), ("OCCUPATION_TYPE", "Laborers", 1),
    ]


@pytest.mark.parametrize(
    ("child", "key", "found_in", "expected"),
    [
        ("bureau", "SK_ID_CURR", APPLICATIONS, 2),
        ("bureau_balance", "SK_ID_BUREAU", ("bureau",), 1),
        ("previous_application", "SK_ID_CURR", APPLICATIONS, 1),
        ("credit_card_balance", "SK_ID_PREV", ("previous_application",), 0),
        ("credit_card_balance", "SK_ID_CURR", APPLICATIONS, 0),
        ("POS_CASH_balance", "SK_ID_PREV", ("previous_application",), 0),
        ("POS_CASH_balance", "SK_ID_CURR", APPLICATIONS, 0),
        ("installments_payments", "SK_ID_PREV", ("previous_application",), 1),
        ("installments_payments", "SK_ID_CURR", APPLICATIONS, 0),
    ],
)
def test_orphans(mini, child, key, found_in, expected):
    refs = parents(mini, *found_in, key=key)
    assert one(p.orphan_count(mini[child], key, refs)) == {f"orphan_{key.lower()}_count": expected}
    rows = p.orphans(mini[child], key, refs)
    assert rows.count() == expected
    assert rows.columns == mini[child].columns


def test_orphan_counts_side_by_side(mini):
    refs = {
        "SK_ID_PREV": parents(mini, "previous_application", key="SK_ID_PREV"),
        "SK_ID_CURR": parents(mini, *APPLICATIONS, key="SK_ID_CURR"),
    }
    assert one(p.orphan_counts(mini["installments_payments"], refs)) == {
        "orphan_sk_id_prev_count": 1, "orphan_sk_id_curr_count": 0,
    }


def test_links_cover_every_reference():
    assert len(LINKS) == len(set(LINKS)) == 9


def test_missing_events(mini):
    assert one(p.missing_event_profile(mini["installments_payments"], "AMT_PAYMENT", "DAYS_ENTRY_PAYMENT")) == {
        "total_rows": 6, "missed_payment_count": 1, "pct_missed_payment": 16.67, "null_days_entry_payment_count": 1,
    }


def test_delays(mini):
    asked = ("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "NUM_INSTALMENT_NUMBER")
    assert one(p.delay_profile(mini["installments_payments"], *asked)) == {
        "min_instalment_number": 1, "max_instalment_number": 2, "min_payment_delay_days": -5.0,
        "max_payment_delay_days": 10.0, "avg_payment_delay_days": 2.2, "late_payment_count": 3,
    }


def test_empty_tables(spark, mini):
    """Counts are 0; sums, rates and bounds are NULL; nothing fails."""
    empty = {name: spark.createDataFrame([], schema) for name, (schema, _) in MINI.items()}
    assert one(p.row_count(empty["bureau"])) == {"row_count": 0}
    assert set(one(p.key_profile(empty["bureau"], ["SK_ID_BUREAU"])).values()) == {0}
    assert set(one(p.key_profile(empty["bureau_balance"], ["SK_ID_BUREAU", "MONTHS_BALANCE"])).values()) == {0}
    rates = one(p.null_rates(empty["application_train"], ["EXT_SOURCE_1"]))
    assert rates == {"total_rows": 0, "pct_null_ext_source_1": None}
    ranges = one(p.range_stats(empty["application_train"], profiles()["application_train"].measures))
    assert set(ranges.values()) == {None}
    assert p.class_balance(empty["application_train"], "TARGET").collect() == []
    assert p.category_counts(empty["application_train"], ["CODE_GENDER"]).collect() == []
    refs = parents(empty, *APPLICATIONS, key="SK_ID_CURR")
    assert one(p.orphan_count(empty["bureau"], "SK_ID_CURR", refs)) == {"orphan_sk_id_curr_count": 0}
    missing = one(p.missing_event_profile(empty["installments_payments"], "AMT_PAYMENT", "DAYS_ENTRY_PAYMENT"))
    assert missing.pop("total_rows") == 0 and set(missing.values()) == {None}
    delays = one(
        p.delay_profile(
            empty["installments_payments"], "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "NUM_INSTALMENT_NUMBER"
        )
    )
    assert set(delays.values()) == {None}


def test_forty_questions():
    asked = [f"{t}_{q}" for t, found in profiles().items() for q in table_questions(t, found)]
    assert len(asked) == len(set(asked)) == 40


def test_profile_query(mini):
    assert one(profile_query(mini, "bureau", "orphan_sk_id_curr")) == {"orphan_sk_id_curr_count": 2}


def test_profile_table_is_the_single_results_in_long_form(mini):
    df = mini["installments_payments"]
    measures = [p.Measure("due", "DAYS_INSTALMENT", ("min", "max"))]
    long = by(p.profile_table(df, ["AMT_PAYMENT"], measures, {"amount": "AMT_PAYMENT", "day": "DAYS_ENTRY_PAYMENT"}), "metric")
    assert {m: r["value"] for m, r in long.items()} == {
        "total_rows": 6.0, "pct_null_amt_payment": 16.67, "min_due": -100.0, "max_due": -10.0,
        "missed_payment_count": 1.0, "pct_missed_payment": 16.67, "null_days_entry_payment_count": 1.0,
    }


def test_run_all(spark, mini):
    """All tables, given the columns the profiles name."""
    full = {}
    for name, found in profiles().items():
        df = mini[name]
        for column in {*found.nullable, *found.categories, *(m.value for m in found.measures if isinstance(m.value, str))}:
            if column not in df.columns:
                df = df.withColumn(column, F.lit(None).cast("double"))
        full[name] = df
    found = by(run_all(full), "table_name", "metric")
    assert found[("bureau", "orphan_sk_id_curr_count")]["value"] == 2
    assert found[("bureau_balance", "duplicate_key_combo")]["value"] == 2
    assert found[("bureau_balance", "total_rows")]["value"] == 8
    assert found[("installments_payments", "late_payment_count")]["value"] == 3
    assert found[("credit_card_balance", "pct_null_amt_drawings_pos_current")]["value"] == 100


def test_hot_key_against_plain_counting(spark):
    """A third of the rows has one key, a sixth has none."""
    n = 6000
    rows = [(None if i % 6 == 5 else 7 if i % 3 == 0 else 100 + i % 400, i % 13) for i in range(n)]
    df = spark.createDataFrame(rows, "k bigint, v bigint")
    known = spark.createDataFrame([(i,) for i in range(150, 400)], "id bigint")
    expected = sum(1 for k, _ in rows if k is None or not 150 <= k < 400)
    assert one(p.orphan_count(df, "k", [p.Parent(known, "id")])) == {"orphan_k_count": expected}
    assert p.orphans(df, "k", [p.Parent(known, "id")]).count() == expected
    combos = {(k, v) for k, v in rows if k is not None}
    assert one(p.key_profile(df, ["k", "v"])) == {
        "row_count": n, "distinct_k": len({k for k, _ in rows if k is not None}),
        "distinct_key_combo": len(combos), "duplicate_key_combo": n - len(combos),
    }


def test_delays_share_the_scan_of_the_table(spark):
    rows = [(1, -10.0, -12.0, 5.0), (2, -10.0, -3.0, 5.0), (9, -10.0, None, None), (None, None, -1.0, 2.0)]
    df = spark.createDataFrame(rows, "number int, due double, paid double, amount double")
    delay = ("due", "paid", "number")
    for part in (df, df.where("paid IS NULL"), df.limit(0)):
        alone = {r["metric"]: r["value"] for r in p.long_form(p.delay_profile(part, *delay)).collect()}
        shared = {r["metric"]: r["value"] for r in p.profile_table(part, delay=delay).collect()}
        assert alone == {m: shared[m] for m in alone} and len(shared) == len(alone) + 1
