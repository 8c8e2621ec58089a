"""Conforming: types, sentinels, NULLs, duplicates, derived columns."""

import pytest
from conftest import by, one, plan_of
from pyspark.sql import functions as F

from credit_marts.functions import days_to_years, safe_cast
from credit_marts.operators import conform as c


def values(df, column):
    return [r[column] for r in df.select(column).collect()]


def test_standardize_types_and_rejects(spark):
    df = spark.createDataFrame(
        [("1", 1.0, "1.5", 5), (" 2 ", 2.5, "x", 3000000000), ("x", None, None, None), ("99999999999", 1e30, "-1e3", -1)],
        "a string, b double, c string, d bigint",
    )
    types = {"a": "int", "b": "bigint", "c": "double", "d": "INT"}
    out = c.standardize_types(df, types)
    assert out.dtypes == [("a", "int"), ("b", "bigint"), ("c", "double"), ("d", "int")]
    assert values(out, "a") == [1, 2, None, None]
    assert values(out, "b") == [1, None, None, None]
    assert values(out, "c") == [1.5, None, None, -1000.0]
    assert values(out, "d") == [5, None, None, -1]
    assert one(c.cast_rejects(df, types)) == {"rejected_a": 2, "rejected_b": 2, "rejected_c": 1, "rejected_d": 1}


@pytest.mark.parametrize("target", ["tinyint", "smallint", "int", "bigint", "double"])
def test_safe_cast_equals_try_cast_on_text(spark, target):
    texts = ["", " ", "0", "-0", "+7", "127", "128", "-32768", "2147483648", "9223372036854775807", "1.", ".5", "1e2",
             "1E-3", "NaN", "Infinity", "-inf", "1 2", "0x1", "a", "--1", "1.5.2", "\t4\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    source = df.schema["t"].dataType
    row = df.select(safe_cast(F.col("t"), source, target).cast("string").alias("ours"),
                    F.col("t").try_cast(target).cast("string").alias("spark")).collect()
    assert [r.ours for r in row] == [r.spark for r in row]


def test_sentinel_to_null(mini):
    out = c.sentinel_to_null(mini["previous_application"], {"DAYS_FIRST_DRAWING": 365243})
    found = by(out, "SK_ID_PREV")
    assert {k: (r["DAYS_FIRST_DRAWING"], r["DAYS_FIRST_DRAWING_was_sentinel"]) for k, r in found.items()} == {
        21: (-20.0, 0), 22: (None, 1), 23: (None, 1), 24: (None, 0),
    }
    assert "x" not in c.sentinel_to_null(out, {"AMT_CREDIT": 0}, flag=False).columns


def test_null_policy(mini):
    out = c.null_policy(
        mini["credit_card_balance"],
        {"AMT_DRAWINGS_ATM_CURRENT": "zero", "CNT_DRAWINGS_ATM_CURRENT": "flag", "AMT_BALANCE": "keep"},
    )
    assert sorted(values(out, "AMT_DRAWINGS_ATM_CURRENT")) == [0.0, 0.0, 20.0]
    assert sorted(values(out, "CNT_DRAWINGS_ATM_CURRENT_is_null")) == [0, 1, 1]
    assert values(out, "CNT_DRAWINGS_ATM_CURRENT").count(None) == 2
    with pytest.raises(ValueError):
        c.null_policy(out, {"AMT_BALANCE": "mean"})


def test_dedup_is_deterministic_and_keeps_null_keys(mini):
    out = c.dedup(mini["bureau_balance"], ["SK_ID_BUREAU", "MONTHS_BALANCE"])
    assert out.count() == 7  # one true duplicate gone, the row without a month kept
    assert out.where("MONTHS_BALANCE IS NULL").count() == 1


def test_dedup_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 9, "c"), (1, 9, "a"), (2, 1, "x"), (None, 1, "y"), (None, 1, "y")],
                               "k bigint, t bigint, v string")
    out = c.dedup(df.repartition(4), ["k"], [F.col("t").desc()])
    assert sorted((r.k or 0, r.t, r.v) for r in out.collect()) == [(0, 1, "y"), (0, 1, "y"), (1, 9, "a"), (2, 1, "x")]


def test_dedup_rare_equals_dedup(spark):
    """No key, few keys and many keys repeated; one of them very often; NULL keys."""
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else i % 1000, i % 2, i % 5, f"v{i % 7}") for i in range(1500)]
    df = spark.createDataFrame(rows, "k bigint, m bigint, t bigint, v string").repartition(5)
    order = [F.col("t").desc()]
    plain = sorted(map(str, c.dedup(df, ["k", "m"], order).collect()))
    assert sorted(map(str, c.dedup_rare(df, ["k", "m"], order).collect())) == plain
    expected = {}
    for k, m, t, v in rows:
        if k is not None and ((k, m) not in expected or (-t, v) < expected[(k, m)]):
            expected[(k, m)] = (-t, v)
    nulls = sum(k is None for k, *_ in rows)
    assert len(plain) == len(expected) + nulls
    assert {(r.k, r.m): (-r.t, r.v) for r in c.dedup(df, ["k", "m"], order).collect() if r.k is not None} == expected


def test_drop_full_duplicates_rare(spark):
    rows = [(None if i % 9 == 0 else i % 300, float(i % 2) * -0.0 if i % 4 else 0.0, f"v{i % 5}") for i in range(900)]
    df = spark.createDataFrame(rows, "k bigint, x double, v string").repartition(5)
    plain = sorted(map(str, c.drop_full_duplicates(df).collect()))
    found = c.drop_full_duplicates_rare(df)
    assert found.columns == df.columns
    assert sorted(str(r).replace("-0.0", "0.0") for r in found.collect()) == [r.replace("-0.0", "0.0") for r in plain]
    assert len(plain) == len({(k, x, v) for k, x, v in rows})


def test_dedup_rare_leaves_a_clean_table_alone(spark):
    df = spark.range(100)
    assert c.dedup_rare(df, ["id"]) is df


def test_dedup_rare_does_not_exchange_rows_with_single_keys(spark):
    df = spark.range(100).selectExpr("id AS k", "id AS v").unionAll(spark.createDataFrame([(5, 1)], "k bigint, v bigint"))
    out = c.dedup_rare(df, ["k"])
    assert out.count() == 100
    single = plan_of(out).split("LeftSemi")[0].split("WindowGroupLimit")[0].split(":- ")[1]
    assert "Exchange hashpartitioning" not in single.split("Window")[0]


def test_drop_full_duplicates_keeps_partial_payments(mini):
    df = mini["installments_payments"]
    assert c.drop_full_duplicates(df).count() == 6
    assert c.drop_full_duplicates(df.unionAll(df)).count() == 6


def test_unify_applications(mini):
    out = c.unify_applications(mini["application_train"], mini["application_test"])
    assert out.count() == 6
    assert sorted(values(out.where("is_train = 0"), "TARGET"), key=str) == [None, None]
    both_without = c.unify_applications(mini["application_test"], mini["application_test"])
    assert both_without.schema["TARGET"].dataType.simpleString() == "bigint"


def test_ratio_is_null_at_zero(mini):
    out = by(c.add_ratio(mini["application_train"], "AMT_CREDIT", "AMT_INCOME_TOTAL", "burden"), "SK_ID_CURR")
    assert {k: r["burden"] for k, r in out.items()} == {1: 4.0, 2: 3.0, 3: None}


def test_age_and_grant_gap(mini):
    ages = by(c.add_age(mini["application_train"]), "SK_ID_CURR")
    assert ages[1]["age_years"] == 27.378508
    gaps = by(c.add_grant_gap(mini["previous_application"]), "SK_ID_PREV")
    assert {k: r["grant_gap"] for k, r in gaps.items()} == {21: 100.0, 22: 500.0, 23: 0.0, 24: 0.0}
    assert one(mini["bureau"].agg(F.max(days_to_years(F.col("DAYS_CREDIT") * -1)).cast("double").alias("y")))["y"] == 2.464066


def test_payment_delay(mini):
    out = c.add_payment_delay(mini["installments_payments"])
    found = sorted((r.SK_ID_PREV, r.NUM_INSTALMENT_NUMBER, str(r.payment_delay), r.is_late, r.is_missed) for r in out.collect())
    assert found == [
        (21, 1, "-5.0", 0, 0), (21, 2, "10.0", 1, 0), (21, 2, "5.0", 1, 0), (23, 1, "None", 0, 1),
        (23, 2, "1.0", 1, 0), (96, 1, "0.0", 0, 0),
    ]


def test_status_severity(spark):
    df = spark.createDataFrame([(s,) for s in ["C", "0", "1", "5", "X", "?", None]], "STATUS string")
    out = c.add_status_severity(df)
    assert values(out, "status_severity") == [0, 0, 1, 5, None, None, None]
    assert values(out, "is_delinquent") == [0, 0, 1, 1, 0, 0, 0]


def test_building_block(spark):
    df = spark.createDataFrame([(1.0, 3.0, 5.0, "x"), (None, 4.0, None, "y"), (None, None, None, None)],
                               "A_AVG double, B_AVG double, C_MEDI double, D_MODE string")
    assert c.block_columns(df) == ["A_AVG", "B_AVG", "C_MEDI"]
    out = c.building_block(df, c.block_columns(df, r"\w+_AVG"))
    assert values(out, "building_mean") == [2.0, 4.0, None]
    assert values(out, "building_present") == [2, 1, 0]


def test_mostly_null_columns(mini):
    df = mini["previous_application"]
    report = by(c.null_report(df), "column_name")
    assert report["RATE_INTEREST_PRIMARY"] == {
        "column_name": "RATE_INTEREST_PRIMARY", "total_rows": 4, "null_count": 4, "pct_null": 100.0,
    }
    assert c.mostly_null_columns(df, 99) == ["RATE_INTEREST_PRIMARY"]
    assert "RATE_INTEREST_PRIMARY" not in c.drop_mostly_null(df, 99).columns
    assert c.drop_mostly_null(df, 99, ["AMT_CREDIT"]).columns == df.columns


def test_many_repeated_keys_are_resolved_in_one_exchange(spark, monkeypatch):
    df = spark.range(400).selectExpr("id % 150 AS k", "id AS v", "id % 3 AS w")
    expected = sorted(map(tuple, c.dedup(df, ["k"]).collect()))
    monkeypatch.setattr(c, "MOST_REPEATED", 20)
    out = c.dedup_rare(df, ["k"])
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == expected
    full = c.drop_full_duplicates_rare(df.select("k", "w"))
    assert "Join" not in full._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, df.select("k", "w").distinct().collect()))


def test_dedup_for_a_reader_sorts_and_exchanges_only_what_decides(spark):
    """Every column that is read is the same as with all columns breaking ties; nothing behind the last one is used."""
    rows = [(i % 40, i % 3, None if i % 7 == 0 else i % 4, i % 5, f"v{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "k bigint, t bigint, a bigint, b bigint, wide string").repartition(4)
    order = [F.col("t").desc()]
    for read in (["a"], ["b"], ["t"], ["a", "b"], []):
        whole = sorted(map(str, c.dedup(df, ["k"], order).select("k", *read).collect()))
        found = c.dedup(df, ["k"], order, read).select("k", *read)
        assert sorted(map(str, found.collect())) == whole
        assert sorted(map(str, c.dedup_rare(df, ["k"], order, read).select("k", *read).collect())) == whole
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "wide" not in plan.split("Window")[1].split("LogicalRDD")[0]
    assert c.dedup(df, ["k"], (), []).select("k").count() == 40
