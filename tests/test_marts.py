"""Dimensions, fact and reports."""

import pytest
from conftest import by, one
from pyspark.sql import functions as F

from credit_marts.operators import checks, conform, marts, reports


@pytest.fixture(scope="module")
def dims(mini):
    return {
        "bureau": marts.dim_bureau(mini["bureau"], marts.status_by_credit(mini["bureau_balance"])),
        "previous_application": marts.dim_previous_application(mini["previous_application"], reasons=["HC"]),
        "installments_agg": marts.dim_installments_agg(mini["installments_payments"]),
        "credit_card_agg": marts.dim_credit_card_agg(mini["credit_card_balance"]),
        "pos_cash_agg": marts.dim_pos_cash_agg(mini["POS_CASH_balance"]),
    }


@pytest.fixture(scope="module")
def fact(mini, dims):
    applications = conform.unify_applications(mini["application_train"], mini["application_test"])
    return marts.fact_application(conform.drop_full_duplicates(applications), dims)


def test_status_by_credit(mini):
    found = by(marts.status_by_credit(mini["bureau_balance"]), "SK_ID_BUREAU")
    assert {
        k: (r["month_count"], r["worst_status"], r["delinquent_month_count"], round(r["delinquent_share"], 4))
        for k, r in found.items()
    } == {11: (3, 1, 2, 0.6667), 12: (1, 0, 0, 0.0), 13: (3, 5, 1, 0.3333), 98: (1, 0, 0, 0.0)}


def test_unknown_months_only(spark):
    df = spark.createDataFrame([(1, "X"), (1, "X")], "SK_ID_BUREAU bigint, STATUS string")
    assert one(marts.status_by_credit(df)) == {
        "SK_ID_BUREAU": 1, "month_count": 2, "worst_status": None, "delinquent_month_count": 0, "delinquent_share": 0.0,
    }


def test_dim_bureau(dims):
    found = by(dims["bureau"], "SK_ID_CURR")
    assert set(found) == {1, 2, 4, 99}  # the row without an applicant belongs to nobody
    assert found[1] == {
        "SK_ID_CURR": 1, "bureau_count": 2, "bureau_active_count": 1, "bureau_closed_count": 1,
        "bureau_debt_sum": 1000.0, "bureau_day_overdue_max": 0, "bureau_amt_overdue_max": None,
        "bureau_days_credit_latest": -100, "bureau_month_count": 4, "bureau_worst_status": 1,
        "bureau_delinquent_share": 0.5,
    }
    assert (found[4]["bureau_month_count"], found[4]["bureau_worst_status"], found[4]["bureau_delinquent_share"]) == (0, None, None)


def test_dim_bureau_without_statuses(mini):
    assert "bureau_month_count" not in marts.dim_bureau(mini["bureau"]).columns


def test_dim_previous_application(dims):
    found = by(dims["previous_application"], "SK_ID_CURR")
    assert found[1] == {
        "SK_ID_CURR": 1, "previous_count": 2, "previous_approved_count": 1, "previous_refused_count": 1,
        "previous_cancelled_count": 0, "previous_unused_count": 0, "previous_reason_hc_count": 1,
        "previous_grant_gap_mean": 300.0,
    }
    assert found[97]["previous_cancelled_count"] == 1


def test_dim_installments(dims):
    found = by(dims["installments_agg"], "SK_ID_CURR")
    names = ["count", "missed_count", "late_count", "delay_mean", "delay_max", "underpaid_share", "paid_sum"]
    assert {k: tuple(r[f"instalment_{n}"] for n in names) for k, r in found.items()} == {
        1: (4, 0, 3, 2.75, 10.0, 0.5, 40.0),
        2: (2, 1, 0, 0.0, 0.0, 0.0, 5.0),
    }


def test_dim_credit_card(dims):
    found = by(dims["credit_card_agg"], "SK_ID_CURR")
    assert {k: (round(r["card_utilization_mean"] or -1, 6), r["card_utilization_max"], r["card_dpd_max"], r["card_atm_drawing_count"])
            for k, r in found.items()} == {1: (0.7, 0.9, 3, 2), 2: (-1, None, 0, 0)}


def test_dim_pos_cash(dims):
    found = by(dims["pos_cash_agg"], "SK_ID_CURR")
    assert found[1] == {
        "SK_ID_CURR": 1, "pos_month_count": 2, "pos_dpd_max": 5, "pos_dpd_mean": 2.5, "pos_dpd_def_max": 0,
        "pos_dpd_def_mean": 0.0, "pos_active_count": 2, "pos_completed_count": 0,
    }


def test_dimensions_are_unique(dims):
    for dim in dims.values():
        assert one(checks.unique_check(dim, ["SK_ID_CURR"]))["is_unique"]


def test_fact_has_one_row_per_application(fact):
    found = by(fact, "SK_ID_CURR")
    assert len(found) == fact.count() == 5
    thin = found[5]
    assert [thin[f"has_{n}_history"] for n in ("bureau", "previous_application", "installments_agg")] == [0, 0, 0]
    assert {v for k, v in thin.items() if k.endswith("_count")} == {0}
    assert thin["bureau_debt_sum"] is thin["instalment_delay_mean"] is thin["bureau_worst_status"] is None
    assert (found[1]["has_bureau_history"], found[4]["has_bureau_history"]) == (1, 1)
    assert found[4]["has_installments_agg_history"] == 0


def test_risk_by_segment(fact):
    rows = [tuple(r) for r in reports.risk_by_segment(fact, "NAME_INCOME_TYPE").collect()]
    assert rows == [("Pensioner", 1, 1, 1, 1.0), ("Student", 1, 0, 0, None), ("Working", 3, 2, 0, 0.0)]


def test_default_rate_by_band(fact):
    rows = [tuple(r) for r in reports.default_rate_by_band(fact, "AMT_INCOME_TOTAL", [20000, 50000, 100000]).collect()]
    assert rows == [
        (0, "< 20000", 1, 1, 0, 0.0), (1, "20000 - 50000", 1, 0, 0, None), (2, "50000 - 100000", 2, 1, 1, 1.0),
        (3, ">= 100000", 1, 1, 0, 0.0),
    ]
    unknown = reports.default_rate_by_band(fact.withColumn("x", F.lit(None).cast("double")), "x", [0])
    assert one(unknown)["band"] is None


def test_applicant_detail(fact):
    assert one(reports.applicant_detail(fact, 2))["TARGET"] == 1


def test_hot_applicant_against_plain_counting(spark):
    """A third of all payments belongs to one applicant."""
    rows = [(7 if i % 3 == 0 else 100 + i % 50, float(i % 11), float(i % 17), 10.0, float(i % 20)) for i in range(3000)]
    df = spark.createDataFrame(
        rows, "SK_ID_CURR bigint, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double"
    )
    found = by(marts.dim_installments_agg(df), "SK_ID_CURR")
    for key in (7, 100, 149):
        mine = [r for r in rows if r[0] == key]
        assert found[key]["instalment_count"] == len(mine)
        assert found[key]["instalment_late_count"] == sum(r[2] > r[1] for r in mine)
        assert found[key]["instalment_delay_max"] == max(r[2] - r[1] for r in mine)
        assert found[key]["instalment_underpaid_share"] == sum(r[4] < r[3] for r in mine) / len(mine)


def test_only_changed_parts_of_a_fact_are_written(spark, tmp_path):
    from credit_marts.plans.refresh import PART, refresh_fact
    from credit_marts.sources import ensure_schemas

    ensure_schemas(spark, layers=("gold",), prefix="part_", location=str(tmp_path))
    name = "spark_catalog.part_gold.fact"
    people = spark.range(200).select(F.col("id").alias("SK_ID_CURR"), (F.col("id") * 2).alias("AMT"))
    cards = people.where("SK_ID_CURR % 3 = 0").select("SK_ID_CURR", F.lit(1).cast("bigint").alias("card_count"))

    def build(tables):
        return marts.fact_application(tables["people"], {"card": tables["card"]})

    def same(people, cards):
        kept = spark.table(name).drop(PART)
        whole = build({"people": people, "card": cards}).select(*kept.columns)
        assert kept.exceptAll(whole).count() == whole.exceptAll(kept).count() == 0

    assert len(refresh_fact(spark, name, {"people": people, "card": cards}, build, parts=16)) == 16
    same(people, cards)
    files = {f for f in spark.table(name).inputFiles()}
    assert refresh_fact(spark, name, {"people": people, "card": cards}, build, parts=16) == []
    other = cards.withColumn("card_count", F.when(F.col("SK_ID_CURR") == 9, 5).otherwise(F.col("card_count")))
    assert len(refresh_fact(spark, name, {"people": people, "card": other}, build, parts=16)) == 1
    same(people, other)
    assert len(files - set(spark.table(name).inputFiles())) <= len(files) // 8  # the rest is as it was
    # A part that loses all its applicants is dropped; new applicants and columns come in.
    part = spark.table(name).where("SK_ID_CURR = 9").first()[PART]
    kept_ids = [r["SK_ID_CURR"] for r in spark.table(name).where(F.col(PART) != part).collect()]
    fewer = people.where(F.col("SK_ID_CURR").isin(kept_ids))
    assert refresh_fact(spark, name, {"people": fewer, "card": other}, build, parts=16) == [part]
    same(fewer, other)
    more = people.unionAll(spark.createDataFrame([(1000, 1), (None, 2)], "SK_ID_CURR bigint, AMT bigint"))
    refresh_fact(spark, name, {"people": more, "card": other}, build, parts=16)
    same(more, other)
    wider = more.withColumn("NEW", F.lit("x"))
    assert len(refresh_fact(spark, name, {"people": wider, "card": other}, build, parts=16)) == 16
    same(wider, other)


def test_key_profiles_share_an_exchange(spark):
    from conftest import plan_of

    from credit_marts.operators import profile

    rows = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (None, 2, "a"), (1, 1, "b"), (None, None, None)], "a int, b int, c string")
    sets = [("a",), ("a", "b"), ("c", "b")]
    found = {r["key_columns"]: tuple(r)[1:] for r in profile.key_profiles(rows, sets).collect()}
    assert found == {"a": (5, 1, 4), "a,b": (5, 2, 3), "c,b": (5, 2, 3)}
    single = profile.key_profile(rows, ["a", "b"]).first()
    assert found["a,b"] == (single["row_count"], single["distinct_key_combo"], single["duplicate_key_combo"])
    assert {tuple(r)[1:] for r in profile.key_profiles(rows.limit(0), sets).collect()} == {(0, 0, 0)}
    alone = sum(plan_of(profile.key_profile(rows, list(k))).count("Exchange hashpartitioning") for k in sets)
    assert plan_of(profile.key_profiles(rows, sets)).count("Exchange hashpartitioning") < alone
