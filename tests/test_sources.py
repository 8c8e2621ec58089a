"""Sources and sinks."""

import pytest
from conftest import plan_of

from credit_marts.sources import (
    csv_to_table,
    ensure_schemas,
    infer_types,
    jdbc_options,
    land,
    land_all,
    named_types,
    read_csv,
    read_table,
    work_dir,
    write_table,
)
from credit_marts.sources.jdbc import KeyRange


@pytest.fixture
def csv(tmp_path):
    def write(text: str) -> str:
        path = tmp_path / "data.csv"
        path.write_text(text)
        return str(path)

    return write


def test_empty_quoted_empty_and_na(spark, csv):
    path = csv('SK_ID_CURR,NAME_TYPE_SUITE,OCCUPATION_TYPE\n1,,NA\n2,"",x\n3,"a ""b"", c",\n')
    rows = [tuple(r) for r in read_csv(spark, path).orderBy("SK_ID_CURR").collect()]
    assert rows == [(1, None, "NA"), (2, "", "x"), (3, 'a "b", c', None)]


def test_value_that_does_not_fit_fails(spark, csv):
    path = csv("SK_ID_CURR,TARGET\n1,0\n2,zero\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv(spark, path).collect()


def test_named_types():
    types = {f.name: f.dataType.simpleString() for f in named_types(
        ["SK_ID_CURR", "SK_BUREAU_ID", "TARGET", "NAME_INCOME_TYPE", "AMT_CREDIT", "AMT_CREDIT_LIMIT_ACTUAL"]
        + ["DAYS_BIRTH", "DAYS_INSTALMENT", "CNT_PAYMENT", "FLAG_OWN_CAR", "FLAG_DOCUMENT_3", "APARTMENTS_AVG"]
        + ["WALLSMATERIAL_MODE", "EXT_SOURCE_1", "SK_DPD_DEF", "STATUS", "NUM_INSTALMENT_NUMBER", "NUM_INSTALMENT_VERSION"]
        + ["MONTHS_BALANCE", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "CREDIT_TYPE"]
    ).fields}
    assert types == {
        "SK_ID_CURR": "bigint", "SK_BUREAU_ID": "bigint", "TARGET": "bigint", "NAME_INCOME_TYPE": "string",
        "AMT_CREDIT": "double", "AMT_CREDIT_LIMIT_ACTUAL": "bigint", "DAYS_BIRTH": "bigint",
        "DAYS_INSTALMENT": "double", "CNT_PAYMENT": "double", "FLAG_OWN_CAR": "string", "FLAG_DOCUMENT_3": "bigint",
        "APARTMENTS_AVG": "double", "WALLSMATERIAL_MODE": "string", "EXT_SOURCE_1": "double", "SK_DPD_DEF": "bigint",
        "STATUS": "string", "NUM_INSTALMENT_NUMBER": "bigint", "NUM_INSTALMENT_VERSION": "double",
        "MONTHS_BALANCE": "bigint", "CREDIT_DAY_OVERDUE": "bigint", "DAYS_CREDIT": "bigint",
        "DAYS_CREDIT_ENDDATE": "double", "CREDIT_TYPE": "string",
    }


def test_inferred_types(spark, csv):
    path = csv(
        "whole,gaps,real,truth,text,empty,late\n"
        "1,5,1.5,true,a,,1\n-2,,2,FALSE,3,,2\n3,7,1e3,True,NA,,2.5\n"
    )
    found = {f.name: f.dataType.simpleString() for f in infer_types(spark, path).fields}
    assert found == {
        "whole": "bigint", "gaps": "double", "real": "double", "truth": "boolean", "text": "string",
        "empty": "double", "late": "double",
    }
    first_two = {f.name: f.dataType.simpleString() for f in infer_types(spark, path, sample_rows=2).fields}
    assert first_two["late"] == "bigint"
    assert read_csv(spark, path, infer=True).select("late").collect()[2][0] == 2.5


def test_what_is_inferred_can_be_read(spark, csv):
    path = csv("a,b,c,d,e,f\n 5,nan,+7,1.,99999999999999999999,true\n6,1.5,-8,.5e-3,1,False\n")
    frame = read_csv(spark, path, infer=True)
    assert [t for _, t in frame.dtypes] == ["string", "string", "bigint", "double", "double", "boolean"]
    assert [tuple(r) for r in frame.collect()] == [(" 5", "nan", 7, 1.0, 1e20, True), ("6", "1.5", -8, 0.0005, 1.0, False)]


def test_late_values_are_seen(spark, csv):
    path = csv("n\n" + "1\n" * 20_000 + "0.5\n")
    assert read_csv(spark, path, infer=True).dtypes == [("n", "double")]


def test_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("SK_ID_BUREAU,SK_ID_CURR\n1,2\n")
    (folder / "b.csv").write_text("SK_ID_CURR,SK_ID_BUREAU\n3,4\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(folder)).collect()


def test_line_breaks_in_quotes(spark, csv):
    path = csv('k,v\n1,"two\nlines"\n2,"a ""b"""\n')
    rows = read_csv(spark, path, infer=True, lines=True).collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines"), (2, 'a "b"')]


def test_csv_to_table(spark, csv):
    ensure_schemas(spark)
    path = csv("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,-1,C\n1,-2,0\n")
    assert csv_to_table(spark, path, "spark_catalog.bronze.from_csv") == 2
    table = read_table(spark, "spark_catalog.bronze.from_csv")
    assert table.dtypes == [("SK_ID_BUREAU", "bigint"), ("MONTHS_BALANCE", "bigint"), ("STATUS", "string")]


def test_land_is_snappy_parquet_and_counts(spark, tmp_path):
    assert land(spark.range(5), str(tmp_path), "POS_CASH_balance") == 5
    assert land(spark.range(3), str(tmp_path), "POS_CASH_balance") == 3
    files = list((tmp_path / "POS_CASH_balance").glob("*.snappy.parquet"))
    assert files
    assert spark.read.parquet(str(tmp_path / "POS_CASH_balance")).count() == 3


def test_write_table_counts_rows_after_a_shuffle(spark):
    ensure_schemas(spark)
    df = spark.range(1000).repartition(7).where("id >= 10")
    assert write_table(df, "spark_catalog.bronze.counted") == 990
    assert write_table(df.limit(0), "spark_catalog.bronze.counted") == 0


def test_ensure_schemas_can_be_repeated(spark):
    ensure_schemas(spark)
    ensure_schemas(spark)
    assert {"bronze", "silver", "gold"} <= {d.name for d in spark.catalog.listDatabases()}


def test_bucketed_tables_join_without_exchange(spark):
    ensure_schemas(spark)
    for name in ("left_side", "right_side"):
        df = spark.range(500).selectExpr("id AS k", f"id * 2 AS {name}")
        assert write_table(df, f"spark_catalog.gold.{name}", buckets=(4, "k")) == 500
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("spark_catalog.gold.left_side").join(spark.table("spark_catalog.gold.right_side"), "k")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_work_dir_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark), work_dir(spark)
    assert first.startswith(shared) and first != second


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "POS_CASH_balance", KeyRange("SK_ID_PREV", 1, 100, 4), connection={"user": "u"})
    assert options == {
        "url": "jdbc:x", "dbtable": '"POS_CASH_balance"', "fetchsize": "10000", "user": "u",
        "partitionColumn": "SK_ID_PREV", "lowerBound": "1", "upperBound": "100", "numPartitions": "4",
    }
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")


def test_land_all_reads_each_table_and_lands_it(spark, tmp_path, monkeypatch):
    """Without a database: the read is replaced, its arguments are checked."""
    asked = []

    def read(session, url, table, split=None, **kw):
        asked.append((url, table, split, kw))
        return session.range(len(asked))

    monkeypatch.setattr("credit_marts.sources.jdbc.read_jdbc", read)
    split = KeyRange("SK_ID_PREV", 1, 9)
    rows = land_all(
        spark, "jdbc:x", str(tmp_path), {"bureau": None, "POS_CASH_balance": split}, fetch_rows=5
    )
    assert rows == {"bureau": 1, "POS_CASH_balance": 2}
    assert asked == [
        ("jdbc:x", "bureau", None, {"fetch_rows": 5}), ("jdbc:x", "POS_CASH_balance", split, {"fetch_rows": 5}),
    ]
    assert spark.read.parquet(str(tmp_path / "POS_CASH_balance")).count() == 2


def test_broken_lines_are_kept_apart(spark, tmp_path):
    from credit_marts.operators import checks
    from credit_marts.sources.quarantine import LINE, REASON, SOURCE, read_quarantined_csv, write_quarantined

    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("SK_ID_CURR,SK_ID_BUREAU,CREDIT_DAY_OVERDUE,CREDIT_TYPE\n1,10,0,a\n2,x,0,b\n3,12,-5,c\n")
    (folder / "b.csv").write_text("SK_ID_CURR,SK_ID_BUREAU,CREDIT_DAY_OVERDUE,CREDIT_TYPE\n4,13,1,d\n,14,9,e\n6,15\n")
    ensure_schemas(spark)
    rules = [checks.not_null("SK_ID_CURR"), checks.in_range("CREDIT_DAY_OVERDUE", low=0)]
    frame = read_quarantined_csv(spark, str(folder))
    name, path = "spark_catalog.silver.parted", str(tmp_path / "parted")
    assert write_quarantined(frame, name, path, rules=rules) == (2, 4)
    assert sorted(r["SK_ID_CURR"] for r in spark.table(name).collect()) == [1, 4]
    assert not {REASON, SOURCE, LINE} & set(spark.table(name).columns)
    rejected = {r[REASON]: r for r in spark.table(f"{name}__rejected").collect() if r[REASON] != "malformed line"}
    assert set(rejected) == {"in_range(CREDIT_DAY_OVERDUE, 0..)", "not_null(SK_ID_CURR)"}
    broken = {r[LINE]: r[SOURCE] for r in spark.table(f"{name}__rejected").collect() if r[LINE]}
    assert {line: source[-5:] for line, source in broken.items()} == {"2,x,0,b": "a.csv", "6,15": "b.csv"}
    # A clean delivery empties the rejects.
    assert write_quarantined(frame.where("SK_ID_CURR = 1"), name, path, rules=rules) == (1, 0)
    assert spark.table(name).count() == 1 and spark.table(f"{name}__rejected").count() == 0
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv(spark, str(folder)).collect()
