"""Shapes of the physical plans: what is read, what is exchanged, what is joined how."""

import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from credit_marts.operators import conform, marts, profile, reports
from credit_marts.sources import ensure_schemas, write_table
from workloads import credit_layers

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")

# Writing queries are covered by their results; planning them would store tables.
WRITING = {"fact_refresh", "quarantine_lines", "quality_report", "gold_fact_application", "applicant_detail", "ingest_roundtrip", "csv_roundtrip", "csv_inferred_types", "layers_end_to_end", "dedup_rare", "drop_full_duplicates_rare"}
# Its filter goes to all tasks: a number of rows that is a parameter.
BOUNDED = {"orphan_rows_by_bloom"}
PLANNED = sorted(q for q in entry.queries() if q not in WRITING | BOUNDED and not re.match(r"op\d|pipeline", q))


@contextmanager
def without_broadcast(spark):
    """As for tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def columns_read(plan: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+)#\d+", scan)) for scan in re.findall(r"FileScan parquet \S*?\[([^\]]*)\]", plan)]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(spark, name):
    with without_broadcast(spark):
        plan = plan_of(entry.queries()[name](spark, SF))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Broadcast(Hash)?Join|Python|Pandas|Arrow", plan)


@pytest.mark.parametrize(
    "name", ["null_rates", "range_stats", "sentinel_stats", "missing_event_profile", "expectations", "profile_table"]
)
def test_one_scan_per_table(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    files = re.findall(r"(\w+)\.parquet\]", plan)
    assert len(files) == len(set(files))


def test_only_needed_columns_are_read(spark):
    lines = table(spark, "lineitem")
    assert columns_read(plan_of(profile.null_rates(lines, ["l_tax"]))) == [{"l_tax"}]
    assert columns_read(plan_of(profile.row_count(lines))) == [set()]
    counts = profile.category_counts(lines, ["l_returnflag", "l_linestatus"])
    assert columns_read(plan_of(counts)) == [{"l_returnflag"}, {"l_linestatus"}]


def test_one_pass_categories_scan_once(spark):
    plan = plan_of(profile.category_counts(table(spark, "lineitem"), ["l_returnflag", "l_linenumber"], one_pass=True))
    assert columns_read(plan) == [{"l_returnflag", "l_linenumber"}]


def test_delay_filter_reaches_the_scan(spark):
    lines = table(spark, "lineitem")
    plan = plan_of(profile.delay_profile(lines, "l_quantity", "l_extendedprice", "l_linenumber"))
    assert "PushedFilters: [IsNotNull(l_extendedprice)]" in plan


def test_child_is_reduced_before_the_anti_joins(spark):
    parents = [profile.Parent(table(spark, "supplier"), "s_suppkey"), profile.Parent(table(spark, "customer"), "c_custkey")]
    with without_broadcast(spark):
        plan = plan_of(profile.orphan_count(table(spark, "events"), "user_id", parents))
    assert plan.count("LeftAnti") == 2
    # one exchange of the reduced child, one per parent, one for the final sum
    assert plan.count("Exchange") == 4
    below = plan[plan.rindex("LeftAnti"):]
    assert below.index("partial_count(1)") < below.index("events.parquet")


def test_dedup_limits_each_task_before_the_exchange(spark):
    plan = plan_of(conform.dedup(table(spark, "lineitem"), ["l_orderkey", "l_linenumber"]))
    final, exchange, partial = (plan.index(w) for w in ("row_number(), 1, Final", "Exchange hash", "row_number(), 1, Partial"))
    assert final < exchange < partial


def test_class_balance_has_no_window(spark):
    plan = plan_of(profile.class_balance(table(spark, "orders"), "o_orderstatus"))
    assert "Window" not in plan and "Subquery" in plan


def test_class_balance_counts_once(spark):
    df = profile.class_balance(table(spark, "orders"), "o_orderstatus")
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_composite_key_does_not_expand(spark):
    assert "Expand" not in plan_of(profile.key_profile(table(spark, "lineitem"), ["l_orderkey", "l_linenumber"]))


def test_fact_joins_add_no_exchange(spark):
    """One exchange for the base and one per aggregated dimension; none between the joins."""
    orders = table(spark, "orders")
    dims = {
        name: marts.dim_previous_application(
            orders, applicant="o_custkey", status="o_orderstatus", reason="o_orderpriority",
            applied="o_totalprice", granted="o_totalprice",
        ).select(F.col("o_custkey").alias("c_custkey"), F.col("previous_count").alias(f"{name}_count"))
        for name in ("a", "b", "c")
    }
    with without_broadcast(spark):
        plan = plan_of(marts.fact_application(table(spark, "customer"), dims, "c_custkey"))
    assert plan.count("LeftOuter") == 3
    assert plan.count("Exchange") == 4


def test_unused_dimensions_are_not_read(spark):
    dims = {"events": marts.dim_pos_cash_agg(
        table(spark, "events"), applicant="user_id", status="event_type", past_due="value", past_due_tolerant="value"
    ).withColumnRenamed("user_id", "c_custkey")}
    fact = marts.fact_application(table(spark, "customer").withColumn("TARGET", F.lit(1)), dims, "c_custkey")
    assert "events.parquet" not in plan_of(reports.risk_by_segment(fact, "c_mktsegment"))


def test_detail_filter_reaches_the_stored_fact(spark):
    ensure_schemas(spark)
    write_table(table(spark, "customer"), "spark_catalog.gold.detail")
    plan = plan_of(reports.applicant_detail(spark.table("spark_catalog.gold.detail"), 7, "c_custkey"))
    assert "EqualTo(c_custkey,7)" in plan


def test_hot_key_join_is_split_at_run_time(spark):
    """Adaptive execution splits the partition of a key that a third of the rows has."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.shuffle.partitions": "20",
    }
    rows = spark.range(0, 60000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id) AS k", "uuid() AS v")
    known = profile.Parent(spark.range(30000, 40000), "id")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        with without_broadcast(spark):
            found = profile.orphans(rows, "k", [known])
            found.collect()
            plan = plan_of(found)
    finally:
        for key in settings:
            spark.conf.set(key, "4") if key.endswith("shuffle.partitions") else spark.conf.unset(key)
    assert "skew=true" in plan
    missing = [k for k in range(60000) if k % 3 and not 30000 <= k < 40000]
    assert found.count() == 20000 + len(missing)


def test_dedup_scans_its_table_once(spark):
    plan = plan_of(credit_layers._silver(spark, SF)["bureau_balance"])
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_credits_without_an_id_go_around_the_join(spark):
    credits = spark.range(60).selectExpr(
        "id % 5 AS SK_ID_CURR", "nullif(id % 2, 0) * id AS SK_ID_BUREAU", "'Active' AS CREDIT_ACTIVE", "-1L AS DAYS_CREDIT",
        "1.0D AS AMT_CREDIT_SUM_DEBT", "0L AS CREDIT_DAY_OVERDUE", "0.0D AS AMT_CREDIT_MAX_OVERDUE",
    )
    months = spark.range(60).selectExpr("id AS SK_ID_BUREAU", "'1' AS STATUS")
    with without_broadcast(spark):
        out = marts.dim_bureau(credits, marts.status_by_credit(months))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan and re.search(r"Join LeftOuter[^\n]*\n[^\n]*\n?[\s\S]*?isnotnull\(", plan)
        rows = out.collect()
    assert sum(r["bureau_count"] for r in rows) == 60 and sum(r["bureau_month_count"] for r in rows) == 30


def test_the_join_of_repeated_keys_is_left_to_spark(spark):
    rows = spark.range(5000).selectExpr("id % 4990 AS k", "id AS v")
    small = conform.dedup_rare(rows, ["k"])
    assert "BroadcastHashJoin" in plan_of(small) and small.count() == 4990
    with without_broadcast(spark):
        large = conform.dedup_rare(rows, ["k"])
        assert "BroadcastHashJoin" not in plan_of(large) and large.count() == 4990


def scans_of(plan: str) -> list[str]:
    return re.findall(r"FileScan parquet", plan)


def test_every_child_is_scanned_and_grouped_once(spark, tmp_path):
    from credit_marts.operators import checks
    from credit_marts.plans import pipeline

    names = {
        "application": "SK_ID_CURR", "bureau": "SK_ID_CURR SK_ID_BUREAU", "bureau_balance": "SK_ID_BUREAU",
        "previous_application": "SK_ID_PREV SK_ID_CURR", "POS_CASH_balance": "SK_ID_PREV SK_ID_CURR",
        "credit_card_balance": "SK_ID_PREV SK_ID_CURR", "installments_payments": "SK_ID_PREV SK_ID_CURR",
    }
    tables = {}
    for name, columns in names.items():
        spark.range(10).select(*[F.col("id").alias(c) for c in columns.split()]).write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    routes = [checks.Route(t, "SK_ID_PREV", "previous_application", "SK_ID_CURR") for t in pipeline.TWO_ROUTES]
    with without_broadcast(spark):
        plan = plan_of(checks.reference_summary(tables, pipeline.silver_links(), routes))
    children, parents = {link.child for link in pipeline.silver_links()}, len(pipeline.silver_links())
    assert len(scans_of(plan)) == len(children) + parents
    assert not re.search(r"CartesianProduct|NestedLoopJoin|BroadcastHashJoin", plan)


def test_footers_answer_counts_and_bounds(spark):
    from credit_marts.sources import footer_table

    path = f"{SF}/lineitem.parquet"
    lines = footer_table(spark, path)
    plan = plan_of(profile.range_stats(lines, [profile.Measure("quantity", "l_quantity", ("min", "max"))]))
    assert re.search(r"PushedAggregation: \[MIN\(l_quantity\), MAX\(l_quantity\)\]", plan)
    assert "PushedAggregation: [COUNT(*)]" in plan_of(profile.row_count(lines))
    # What a footer cannot say is computed from the rows.
    for measure in (profile.Measure("quantity", "l_quantity"), profile.Measure("quantity", "l_quantity", ("min",), sentinel=50)):
        assert "PushedAggregation: []" in plan_of(profile.range_stats(lines, [measure]))
    assert "FileScan" in plan_of(profile.row_count(table(spark, "lineitem")))  # the caller's session is as before


def test_bloom_filter_keeps_sure_orphans_from_the_exchange(spark):
    parents = spark.range(0, 100_000, 2).withColumnRenamed("id", "p")
    child = spark.range(200_000).select(F.when(F.col("id") % 50 > 0, F.col("id") * 2 + F.col("id") % 2).alias("k"), "id")
    found = profile.orphans_by_bloom(child, "k", [profile.Parent(parents, "p")], blocks=4096)
    plain = profile.orphans(child, "k", [profile.Parent(parents, "p")])
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0
    tight = profile.orphans_by_bloom(child, "k", [profile.Parent(parents, "p")], blocks=1)  # all bits set
    assert tight.exceptAll(plain).count() == 0 and tight.count() == plain.count()
    filters = profile.bloom_blocks(parents, "p", 4096).withColumnRenamed("block", "b")
    block, bits = profile._bloom_block(F.col("k"), 4096), profile._bloom_bits(F.col("k"))
    may = child.where("k IS NOT NULL").join(filters, block == F.col("b"))
    for i, bit in enumerate(bits):
        may = may.where(F.col(f"w{i}").bitwiseAND(bit) != 0)
    known = child.join(parents, child["k"] == parents["p"]).count()
    assert known <= may.count() <= known + 0.01 * child.count()


def test_dimensions_exchange_only_columns_that_decide(spark):
    """What breaks no tie that a dimension could see is neither sorted nor exchanged."""
    unread = {"dim_previous_application": "DAYS_FIRST_DRAWING", "dim_bureau": "AMT_ANNUITY", "dim_credit_card_agg": "SK_DPD_DEF"}
    for name, column in unread.items():
        assert column not in plan_of(entry.queries()[f"gold_{name}"](spark, SF)), name
