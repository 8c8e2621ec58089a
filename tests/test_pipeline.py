"""All layers, stored."""

from pathlib import Path

import pytest
from conftest import by, one, plan_of
from pyspark.sql import functions as F

from credit_marts import run_pipeline
from credit_marts.operators.marts import reason_codes
from credit_marts.plans import gold_tables, silver_tables
from credit_marts.plans.pipeline import quality_report, staged_report
from credit_marts.sources import ensure_schemas, land, shuffles_freed, table_specs, work_dir


@pytest.fixture(scope="module")
def stored(spark, mini):
    root = work_dir(spark)
    for name, df in mini.items():
        land(df, root, name)
    ensure_schemas(spark, prefix="mini_", location=root)
    specs = table_specs(root, schema_prefix="mini_")
    rows = run_pipeline(spark, specs, reasons=["HC"], buckets=3, at_a_time=3)
    return specs, rows, lambda name: spark.table(f"spark_catalog.mini_{name}")


def test_rows_written(stored, mini):
    _, rows, table = stored
    assert {t: n for t, n in rows.items() if t.startswith("bronze.")} == {
        f"bronze.{name}": df.count() for name, df in mini.items()
    }
    assert {t: n for t, n in rows.items() if not t.startswith("bronze.")} == {
        "silver.application": 5, "silver.bureau": 6, "silver.bureau_balance": 7, "silver.previous_application": 4,
        "silver.POS_CASH_balance": 3, "silver.credit_card_balance": 3, "silver.installments_payments": 6,
        "silver.quality_report": 41, "gold.dim_bureau": 4, "gold.dim_previous_application": 3,
        "gold.dim_installments_agg": 2, "gold.dim_credit_card_agg": 2, "gold.dim_pos_cash_agg": 2,
        "gold.fact_application": 5,
    }
    for name, n in rows.items():
        assert table(name).count() == n


def test_silver_types_and_signals(stored):
    _, _, table = stored
    application = table("silver.application")
    types = dict(application.dtypes)
    assert types["DAYS_EMPLOYED"] == types["DAYS_BIRTH"] == types["CNT_CHILDREN"] == "int"
    found = by(application, "SK_ID_CURR")
    assert {k: (r["DAYS_EMPLOYED"], r["DAYS_EMPLOYED_was_sentinel"], r["EXT_SOURCE_1_is_null"]) for k, r in found.items()} == {
        1: (-1000, 0, 0), 2: (None, 1, 1), 3: (-30, 0, 1), 4: (-200, 0, 1), 5: (None, 1, 0),
    }
    assert {k: r["debt_burden"] for k, r in found.items()} == {1: 4.0, 2: 3.0, 3: None, 4: 1.0, 5: 1.5}
    card = table("silver.credit_card_balance")
    assert card.where("AMT_DRAWINGS_ATM_CURRENT IS NULL").count() == 0
    assert sorted(str(r.utilization) for r in card.collect()) == ["0.5", "0.9", "None"]


def test_quality_report(stored):
    _, _, table = stored
    found = by(table("silver.quality_report").where("failed_count > 0"), "check_name", "table_name", "detail")
    assert {k: r["failed_count"] for k, r in found.items()} == {
        ("reference", "bureau", "SK_ID_CURR -> application"): 2,
        ("reference", "bureau_balance", "SK_ID_BUREAU -> bureau"): 1,
        ("reference", "previous_application", "SK_ID_CURR -> application"): 1,
        ("reference", "installments_payments", "SK_ID_PREV -> previous_application"): 1,
        ("dropped", "application", "duplicates"): 1,
        ("dropped", "bureau_balance", "duplicates"): 1,
        ("unique", "application", "SK_ID_CURR"): 1,
        ("unique", "bureau_balance", "SK_ID_BUREAU,MONTHS_BALANCE"): 2,
        ("category_drift", "application", "CODE_GENDER"): 2,
        ("category_drift", "application", "NAME_INCOME_TYPE"): 2,
        ("null_rate_drift", "application", "5 points"): 2,
        ("unique", "installments_payments", "SK_ID_PREV,NUM_INSTALMENT_NUMBER,NUM_INSTALMENT_VERSION"): 1,
        ("route", "installments_payments", "SK_ID_CURR"): 1,
    }


def test_rejected_values_are_counted(mini):
    fractions = mini["bureau"].withColumn("DAYS_CREDIT", F.when(F.col("SK_ID_BUREAU") == 11, -3.5).otherwise(F.col("DAYS_CREDIT")))
    bronze = {**mini, "bureau": fractions}
    report = quality_report(silver_tables(bronze), bronze).where("check_name = 'rejected' AND failed_count > 0")
    assert by(report, "table_name", "detail")[("bureau", "DAYS_CREDIT")]["failed_count"] == 1
    assert report.count() == 1


def test_the_stronger_signal_survives(spark, mini):
    def silver(name, rows, schema):
        return silver_tables({**mini, name: spark.createDataFrame(rows, schema).repartition(3)})[name].collect()

    months = [(1, -1, s) for s in ("0", "5", "X", "C", None)] + [(2, -1, "X"), (2, -1, "0"), (3, None, "1"), (3, None, "1")]
    kept = silver("bureau_balance", months, "SK_ID_BUREAU bigint, MONTHS_BALANCE bigint, STATUS string")
    assert sorted((r.SK_ID_BUREAU, r.STATUS) for r in kept) == [(1, "5"), (2, "0"), (3, "1"), (3, "1")]
    pos = [(1, 9, -1, 0, 0), (1, 9, -1, 40, 0), (1, None, -1, 40, 2), (2, None, -1, 3, 0), (2, 8, -1, 3, 0)]
    kept = silver("POS_CASH_balance", pos, "SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE bigint, SK_DPD bigint, SK_DPD_DEF bigint")
    assert sorted((r.SK_ID_PREV, r.SK_ID_CURR or 0, r.SK_DPD, r.SK_DPD_DEF) for r in kept) == [(1, 0, 40, 2), (2, 8, 3, 0)]
    credits = [(None, 11, -1, 50), (5, 11, -700, 0), (5, 11, -300, 0)]
    kept = silver("bureau", credits, "SK_ID_CURR bigint, SK_ID_BUREAU bigint, DAYS_CREDIT bigint, CREDIT_DAY_OVERDUE bigint")
    assert [(r.SK_ID_CURR, r.DAYS_CREDIT) for r in kept] == [(5, -300)]


def test_reject_reasons_are_found(spark, stored, mini):
    assert reason_codes(mini["previous_application"]) == ["HC", "XAP"]
    with pytest.raises(ValueError, match="more than 3"):
        reason_codes(spark.range(9).selectExpr("cast(id AS string) AS CODE_REJECT_REASON"), most=3)
    specs, *_ = stored
    run_pipeline(spark, specs)
    assert "previous_reason_xap_count" in spark.table("spark_catalog.mini_gold.fact_application").columns
    run_pipeline(spark, specs, reasons=["HC"], buckets=3)


def test_stored_fact_is_the_lazy_one(stored, mini):
    _, _, table = stored
    lazy = gold_tables(silver_tables(mini), ["HC"])["fact_application"]
    kept = table("gold.fact_application")
    assert sorted(lazy.columns) == sorted(kept.columns)
    assert by(lazy, "SK_ID_CURR") == by(kept, "SK_ID_CURR")


def test_fact_signals(stored):
    _, _, table = stored
    found = by(table("gold.fact_application"), "SK_ID_CURR")
    assert (found[1]["bureau_worst_status"], found[1]["bureau_month_count"]) == (1, 3)
    assert found[5]["has_bureau_history"] == 0 and found[5]["bureau_count"] == 0


def test_rerun_replaces_everything(spark, stored):
    specs, rows, table = stored
    assert run_pipeline(spark, specs, reasons=["HC"], buckets=3) == rows
    assert table("gold.fact_application").count() == 5


def test_rules_stop_the_pipeline(spark, stored, mini):
    specs, _, table = stored
    root = work_dir(spark)
    for name, df in mini.items():
        wrong = df.withColumn("STATUS", F.lit("9")) if name == "bureau_balance" else df
        land(wrong, root, name)
    ensure_schemas(spark, prefix="wrong_", location=root)
    with pytest.raises(Exception, match="in_set.STATUS.: 8 rows|in_set.STATUS.: 5 rows|in_set.STATUS"):
        run_pipeline(spark, table_specs(root, schema_prefix="wrong_"))
    assert not spark.catalog.tableExists("spark_catalog.wrong_gold.fact_application")


def test_lazy_tables_are_built_once(spark):
    from credit_marts.plans.lazy import LazyTables

    built = []

    def build():
        built.append(1)
        return spark.range(1)

    tables = LazyTables({"a": build, "b": build})
    assert built == [] and len(tables) == 2 and list(tables) == ["a", "b"]
    assert tables["a"] is tables["a"] and built == [1]
    assert one(tables["b"].selectExpr("count(*) AS n")) == {"n": 1}


class Stopped(BaseException):
    """The driver dies."""


def test_a_run_that_was_stopped_goes_on(spark, mini, monkeypatch):
    from credit_marts.plans import jobs

    root = work_dir(spark)
    for name, df in mini.items():
        land(df, root, name)
    ensure_schemas(spark, prefix="stopped_", location=root)
    specs, done, alive = table_specs(root, schema_prefix="stopped_"), [], [True]
    whole = jobs.LayerJob.run

    def run(self):
        if alive[0] and "dim_credit_card_agg" in self.target:
            raise Stopped
        done.append(self.target.removeprefix("spark_catalog.stopped_"))
        return whole(self)

    monkeypatch.setattr(jobs.LayerJob, "run", run)
    with pytest.raises(Stopped):
        run_pipeline(spark, specs, reasons=["HC"])
    assert len(done) == 8 + 7 + 4 and "gold.dim_pos_cash_agg" in done  # tables of one layer do not wait for each other
    alive[0] = False
    done.clear()
    rows = run_pipeline(spark, specs, reasons=["HC"])
    assert done == ["gold.dim_credit_card_agg", "silver.quality_report", "gold.fact_application"]
    assert rows["bronze.bureau"] == 6 and rows["gold.fact_application"] == 5 and len(rows) == 22
    # A run that finished is followed by a whole one, and so is one whose files or parameters changed.
    done.clear()
    alive[0] = True
    with pytest.raises(Stopped):
        run_pipeline(spark, specs, reasons=["HC"])
    assert len(done) == 19
    land(mini["bureau"].where("SK_ID_BUREAU < 14"), root, "bureau")
    alive[0] = False
    done.clear()
    rows = run_pipeline(spark, specs, reasons=["HC", "XAP"])
    assert done[:3] == ["bronze.bureau", "silver.bureau", "gold.dim_bureau"] and rows["bronze.bureau"] == 3
    assert "silver.application" not in done and "gold.dim_pos_cash_agg" in done
    ledger = spark.table("spark_catalog.stopped_gold.run_ledger")
    assert ledger.select("run_id").distinct().count() == 1 and ledger.count() >= 23


def test_a_publication_that_was_cut_short_is_put_back(spark, monkeypatch):
    from credit_marts.sources import read_table, recover, write_table

    root = work_dir(spark)
    ensure_schemas(spark, prefix="cut_", location=root)
    name = "spark_catalog.cut_gold.t"
    write_table(spark.range(3), name)
    real = type(spark).sql

    def dies(self, text, *args, **kwargs):
        if "__staging RENAME" in text:
            raise Stopped
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", dies)
    monkeypatch.setattr("credit_marts.sources.tables.recover", lambda *a: None)  # nobody is left to do it
    with pytest.raises(Stopped):
        write_table(spark.range(5), name)
    monkeypatch.undo()
    assert not spark.catalog.tableExists(name)
    assert read_table(spark, name).count() == 3 and not recover(spark, name)
    assert write_table(spark.range(7), name) == 7 and read_table(spark, name).count() == 7
    found = {r["tableName"] for r in spark.sql("SHOW TABLES IN spark_catalog.cut_gold").collect()}
    assert found == {"t"}


def test_an_external_place_is_written_once_and_put_back(spark, monkeypatch, tmp_path):
    from credit_marts.sources import recover, tables, write_table

    ensure_schemas(spark)
    name, path = "spark_catalog.gold.placed", str(tmp_path / "placed")
    write_table(spark.range(4), name, path=path, buckets=(2, "id"))
    saved, whole = [], tables._save
    monkeypatch.setattr(tables, "_save", lambda *a: (saved.append(a[1]), whole(*a)))
    wider = spark.range(6).withColumn("more", F.lit("x"))
    assert write_table(wider, name, path=path, buckets=(2, "id"), lookup="id") == 6
    assert saved == [f"{name}__staging"] and spark.table(name).columns == ["id", "more"]
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan then names the buckets
    try:
        assert "SelectedBucketsCount: 1 out of 2" in plan_of(spark.table(name).where("id = 3"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    (tmp_path / "placed").rename(tmp_path / "placed__replaced")
    assert recover(spark, name, path) and spark.table(name).count() == 6
    spark.sql(f"DROP TABLE {name}")


def test_tables_for_the_report_and_the_dimensions_equal_the_whole_ones(spark, mini):
    """Repeated keys whose rows differ in every column: what is read of them is that of the whole tables."""
    from credit_marts.plans import pipeline

    def other(df, name, c):
        number = c not in pipeline.SILVER_KEYS.get(name, df.columns) and df.schema[c].dataType.typeName() != "string"
        return (F.col(c) + 1).cast(df.schema[c].dataType).alias(c) if number else F.col(c)

    bronze = {n: df.unionAll(df.select([other(df, n, c) for c in df.columns])) for n, df in mini.items()}
    whole = silver_tables(bronze)
    narrow = pipeline.report_tables(bronze)
    for name, df in narrow.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, whole[name].select(*df.columns).collect())), name
    report, expected = quality_report(narrow, bronze), quality_report(whole, bronze)
    assert sorted(map(str, report.collect())) == sorted(map(str, expected.collect()))
    for_marts = silver_tables(bronze, reads=pipeline.DIMENSION_READS)
    fact = gold_tables(whole, ["HC"])["fact_application"]
    found = gold_tables(for_marts, ["HC"])["fact_application"]
    assert sorted(map(str, found.collect())) == sorted(map(str, fact.collect()))


def test_installments_are_read_once_for_what_conforming_changed(spark, mini):
    from credit_marts.plans import pipeline

    parts = pipeline.changes(mini, pipeline.report_tables(mini))
    own = [p for p in parts if "installments_payments AS table_name" in p._jdf.queryExecution().analyzed().toString()]
    assert len(own) == 1
    found = {r["check_name"] for r in own[0].collect()}
    assert found == {"rejected", "dropped", "unique"}


def _shuffled(spark):
    """The shuffle files on this machine's disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in Path(folder).rglob("shuffle_*")}


def test_a_run_leaves_no_shuffle_files(spark, mini):
    root = work_dir(spark)
    for name, df in mini.items():
        land(df, root, name)
    ensure_schemas(spark, prefix="freed_", location=root)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, before = spark.conf.get(setting), _shuffled(spark)
    run_pipeline(spark, table_specs(root, schema_prefix="freed_"), reasons=["HC"], at_a_time=3)
    assert not _shuffled(spark) - before and spark.conf.get(setting) == kept
    with pytest.raises(ValueError), shuffles_freed(spark):
        raise ValueError
    assert spark.conf.get(setting) == kept


def test_the_report_by_parts_is_the_report(spark, mini):
    silver = silver_tables(mini)
    found, expected = (sorted(map(tuple, f({n: silver[n] for n in silver}, mini).collect())) for f in (staged_report, quality_report))
    assert found == expected and len(found) == 41
    assert staged_report(silver, mini).dtypes == quality_report(silver, mini).dtypes
