"""Every operator on the test tables as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.functions import age_years
from credit_marts.operators import checks, conform, marts, profile, reports
from credit_marts.sources import TableSpec, csv_to_table, ensure_schemas, footer_table, land, read_csv, work_dir
from credit_marts.sources.quarantine import write_quarantined
from credit_marts.plans import BronzeJob
from workloads import sql
from workloads.credit_profiles import rounded_averages

Query = Callable[[SparkSession, str], DataFrame]

# Statuses of a line: N is clean, A and R are past due by one and two ranks.
LINE_CODES = {"clean": ("N",), "past_due": ("A", "R")}
ORIGIN = "2002-01-01"
BLOCK = ["q", "d", "t"]
BANDS = (0, 2500, 5000, 7500)


class Tables:
    """The test tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def footers(self, name: str) -> DataFrame:
        """A table whose counts and bounds may come from file footers."""
        return footer_table(self.spark, f"{self.sf_dir}/{name}.parquet")

    @property
    def labelled(self) -> DataFrame:
        """Documents with their labels, NULL where there are none."""
        return self.documents.join(self.labels, "doc_id", "left")

    @property
    def order_lines(self) -> DataFrame:
        """Orders with their lines, NULL where there are none."""
        return self.orders.join(self.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")

    @property
    def lines(self) -> DataFrame:
        """Lines with their order: the customer, the day due and the day shipped."""
        joined = self.lineitem.join(self.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        return joined.withColumns({"due": days("o_orderdate"), "shipped": days("l_shipdate")})


def days(timestamp: str) -> Column:
    """Day offset before a fixed day."""
    return F.date_diff(F.col(timestamp).cast("date"), F.lit(ORIGIN).cast("date"))


def days_sql(timestamp: str) -> str:
    return f"date_diff('day', DATE '{ORIGIN}', CAST({timestamp} AS DATE))"


LABELLED = "documents LEFT JOIN labels USING (doc_id)"
ORDER_LINES = "orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"
LINES = (
    f"(SELECT *, CAST({days_sql('o_orderdate')} AS INTEGER) AS due, "
    f"CAST({days_sql('l_shipdate')} AS INTEGER) AS shipped "
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def mean_as_sum(df: DataFrame, mean: str, count: str) -> DataFrame:
    """A mean of amounts in cents as their sum, which rounds the same in any order of addition."""
    total = F.round(F.col(mean) * F.col(count), 2)
    return df.withColumn(mean.replace("_mean", "_sum"), total).drop(mean)


# --- profiling -----------------------------------------------------------------------------


def _flagged_lines(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", F.nullif("l_returnflag", F.lit("N")).alias("flag"))


def _measures() -> list[profile.Measure]:
    return [
        profile.Measure("quantity", "l_quantity"),
        profile.Measure("price", "l_extendedprice"),
        profile.Measure("discount", "l_discount", ("min", "max")),
    ]


def _building(t: Tables) -> DataFrame:
    return t.customer.where("c_mktsegment = 'BUILDING'")


KEY_SETS = (("l_orderkey",), ("l_orderkey", "flag"), ("flag", "half"))

PROFILE: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {
    "key_profile_single": (
        lambda t: profile.key_profile(t.orders, ["o_orderkey"]),
        sql.key_profile("orders", ["o_orderkey"]),
    ),
    "key_profile_composite": (
        lambda t: profile.key_profile(t.lineitem, ["l_orderkey", "l_linenumber"]),
        sql.key_profile("lineitem", ["l_orderkey", "l_linenumber"]),
    ),
    "key_profiles_shared": (
        lambda t: profile.key_profiles(_flagged_lines(t).withColumn("half", F.col("l_orderkey") % 2), KEY_SETS),
        " UNION ALL ".join(
            f"SELECT '{','.join(keys)}' AS key_columns, CAST(sum(n) AS BIGINT) AS row_count, "
            f"count(*) FILTER (WHERE {' AND '.join(k + ' IS NOT NULL' for k in keys)}) AS distinct_count, "
            f"CAST(sum(n) AS BIGINT) - count(*) FILTER (WHERE {' AND '.join(k + ' IS NOT NULL' for k in keys)}) "
            f"AS duplicate_count FROM (SELECT {', '.join(keys)}, count(*) AS n FROM (SELECT l_orderkey, "
            "nullif(l_returnflag, 'N') AS flag, l_orderkey % 2 AS half FROM lineitem) GROUP BY ALL)"
            for keys in KEY_SETS
        ),
    ),
    "key_profile_null_parts": (
        lambda t: profile.key_profile(_flagged_lines(t), ["l_orderkey", "flag"]),
        sql.key_profile(
            "(SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag FROM lineitem)", ["l_orderkey", "flag"]
        ),
    ),
    "row_count": (lambda t: profile.row_count(t.lineitem), "SELECT count(*) AS row_count FROM lineitem"),
    "null_rates": (
        lambda t: profile.null_rates(t.labelled, ["quality", "toxic", "text"]),
        sql.null_rates(LABELLED, ["quality", "toxic", "text"]),
    ),
    "range_stats": (
        lambda t: rounded_averages(profile.range_stats(t.lineitem, _measures())),
        "SELECT "
        + ", ".join(
            [
                sql.stats("quantity", "l_quantity"),
                sql.stats("price", "l_extendedprice"),
                sql.stats("discount", "l_discount", ("min", "max")),
            ]
        )
        + " FROM lineitem",
    ),
    "sentinel_stats": (
        lambda t: rounded_averages(
            profile.range_stats(t.lineitem, [profile.Measure("quantity", "l_quantity", sentinel=50)])
        ),
        f"SELECT {sql.sentinel_stats('quantity', 'l_quantity', 50, ('min', 'max', 'avg'))} FROM lineitem",
    ),
    "age_range": (
        lambda t: rounded_averages(
            profile.range_stats(
                t.orders.select(days("o_orderdate").alias("offset_days")),
                [profile.Measure("age_years", age_years(F.col("offset_days")))],
            )
        ),
        f"SELECT {sql.stats('age_years', 'round(-offset_days / 365.25, 6)')} "
        f"FROM (SELECT {days_sql('o_orderdate')} AS offset_days FROM orders)",
    ),
    "class_balance": (lambda t: profile.class_balance(t.labels, "quality"), sql.class_balance("labels", "quality")),
    "class_balance_with_null": (
        lambda t: profile.class_balance(t.labelled, "toxic"),
        sql.class_balance(f"({LABELLED})", "toxic").replace("(documents", "(SELECT * FROM documents"),
    ),
    "value_counts": (lambda t: profile.value_counts(t.events, "event_type"), sql.value_counts("events", "event_type")),
    "category_counts": (
        lambda t: profile.category_counts(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"]),
        sql.category_counts("lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"]),
    ),
    "category_counts_one_pass": (
        lambda t: profile.category_counts(t.labelled, ["source", "lang", "quality"], one_pass=True),
        sql.category_counts(LABELLED, ["source", "lang", "quality"]),
    ),
    "orphan_one_parent": (
        lambda t: profile.orphan_count(t.events, "user_id", [profile.Parent(t.supplier, "s_suppkey")]),
        sql.orphan_count("events", "user_id", [("supplier", "s_suppkey")]),
    ),
    "orphan_two_parents": (
        lambda t: profile.orphan_count(
            t.events,
            "user_id",
            [profile.Parent(t.supplier, "s_suppkey"), profile.Parent(_building(t), "c_custkey")],
        ),
        sql.orphan_count(
            "events",
            "user_id",
            [
                ("supplier", "s_suppkey"),
                ("(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')", "c_custkey"),
            ],
        ),
    ),
    "orphan_counts": (
        lambda t: profile.orphan_counts(
            t.lineitem,
            {
                "l_orderkey": [profile.Parent(t.events, "event_id")],
                "l_partkey": [profile.Parent(t.supplier, "s_suppkey"), profile.Parent(_building(t), "c_custkey")],
            },
        ),
        "SELECT * FROM ("
        + sql.orphan_count("lineitem", "l_orderkey", [("events", "event_id")])
        + "), ("
        + sql.orphan_count(
            "lineitem",
            "l_partkey",
            [
                ("supplier", "s_suppkey"),
                ("(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')", "c_custkey"),
            ],
        )
        + ")",
    ),
    "orphan_rows": (
        lambda t: profile.orphans(
            t.events.select("event_id", F.nullif("user_id", F.lit(3)).alias("user_id")),
            "user_id",
            [profile.Parent(t.supplier, "s_suppkey"), profile.Parent(_building(t), "c_custkey")],
        ),
        "SELECT * FROM (SELECT event_id, nullif(user_id, 3) AS user_id FROM events) e WHERE NOT EXISTS "
        "(SELECT 1 FROM supplier WHERE s_suppkey = user_id) AND NOT EXISTS "
        "(SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = user_id)",
    ),
    "orphan_rows_by_bloom": (
        lambda t: profile.orphans_by_bloom(
            t.events.select("event_id", F.nullif("user_id", F.lit(3)).alias("user_id")),
            "user_id",
            [profile.Parent(t.supplier, "s_suppkey"), profile.Parent(_building(t), "c_custkey")],
        ),
        "SELECT * FROM (SELECT event_id, nullif(user_id, 3) AS user_id FROM events) e WHERE NOT EXISTS "
        "(SELECT 1 FROM supplier WHERE s_suppkey = user_id) AND NOT EXISTS "
        "(SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey = user_id)",
    ),
    "row_count_footers": (
        lambda t: profile.row_count(t.footers("lineitem")), "SELECT count(*) AS row_count FROM lineitem"
    ),
    "range_stats_footers": (
        lambda t: profile.range_stats(
            t.footers("lineitem"),
            [profile.Measure(m.alias, m.value, ("min", "max")) for m in _measures()],
        ),
        "SELECT "
        + ", ".join(
            sql.stats(name, column, ("min", "max"))
            for name, column in (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"))
        )
        + " FROM lineitem",
    ),
    "missing_event_profile": (
        lambda t: profile.missing_event_profile(t.order_lines, "l_extendedprice", "l_shipdate"),
        "SELECT count(*) AS total_rows, count(*) - count(l_extendedprice) AS missed_payment_count, "
        f"{sql.percent('(count(*) - count(l_extendedprice))', 'count(*)')} AS pct_missed_payment, "
        f"count(*) - count(l_shipdate) AS null_l_shipdate_count FROM {ORDER_LINES}",
    ),
    "delay_profile": (
        lambda t: rounded_averages(profile.delay_profile(t.lines, "due", "shipped", "l_linenumber")),
        f"SELECT {sql.stats('instalment_number', 'l_linenumber', ('min', 'max'))}, "
        f"{sql.stats('payment_delay_days', 'shipped - due')}, "
        f"{sql.ones('shipped > due')} AS late_payment_count FROM {LINES}",
    ),
    "profile_table": (
        lambda t: rounded(
            profile.profile_table(
                t.order_lines,
                ["l_shipdate", "l_returnflag"],
                _measures(),
                {"amount": "l_extendedprice", "day": "l_shipdate"},
            ),
            4,
            "value",
        ),
        "SELECT metric, round(value, 4) AS value FROM (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM (SELECT "
        "count(*) AS total_rows, "
        f"{sql.percent('(count(*) - count(l_shipdate))', 'count(*)')} AS pct_null_l_shipdate, "
        f"{sql.percent('(count(*) - count(l_returnflag))', 'count(*)')} AS pct_null_l_returnflag, "
        + ", ".join(
            [
                sql.stats("quantity", "l_quantity"),
                sql.stats("price", "l_extendedprice"),
                sql.stats("discount", "l_discount", ("min", "max")),
            ]
        )
        + ", count(*) - count(l_extendedprice) AS missed_payment_count, "
        f"{sql.percent('(count(*) - count(l_extendedprice))', 'count(*)')} AS pct_missed_payment, "
        f"count(*) - count(l_shipdate) AS null_l_shipdate_count FROM {ORDER_LINES})) "
        "UNPIVOT INCLUDE NULLS (value FOR metric IN (COLUMNS(*)))",
    ),
}


# --- conforming ----------------------------------------------------------------------------

PART_TYPES = {"p_size": "bigint", "p_retailprice": "int"}


def _half_empty(t: Tables) -> DataFrame:
    """Order lines with two nearly empty columns."""
    return t.order_lines.select(
        "o_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.when(F.col("l_quantity") == 50, F.col("l_quantity")).alias("only_fifty"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.when(F.col("l_tax") > 0.07, F.col("l_tax")).alias("high_tax"),
    )


HALF_EMPTY = (
    "(SELECT o_orderkey, l_linenumber, l_shipdate, CASE WHEN l_quantity = 50 THEN l_quantity END AS only_fifty, "
    "nullif(l_returnflag, 'N') AS flag, CASE WHEN l_tax > 0.07 THEN l_tax END AS high_tax "
    f"FROM {ORDER_LINES})"
)


def _block(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.nullif("l_quantity", F.lit(50.0)).alias("q"),
        F.nullif("l_discount", F.lit(0.0)).alias("d"),
        F.nullif("l_tax", F.lit(0.0)).alias("t"),
    )


CONFORM: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {
    "standardize_types": (
        lambda t: conform.standardize_types(t.part, PART_TYPES),
        "SELECT * REPLACE (CAST(p_size AS BIGINT) AS p_size, CASE WHEN p_retailprice = floor(p_retailprice) "
        "THEN CAST(p_retailprice AS INTEGER) END AS p_retailprice) FROM part",
    ),
    "cast_rejects": (
        lambda t: conform.cast_rejects(t.order_lines, {"o_orderpriority": "int", "l_discount": "int", "l_tax": "double"}),
        "SELECT count(*) - count(TRY_CAST(o_orderpriority AS INTEGER)) AS rejected_o_orderpriority, "
        "count(*) FILTER (WHERE l_discount <> floor(l_discount)) AS rejected_l_discount, "
        f"CAST(0 AS BIGINT) AS rejected_l_tax FROM {ORDER_LINES}",
    ),
    "sentinel_to_null": (
        lambda t: conform.sentinel_to_null(
            t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"),
            {"l_quantity": 50},
        ),
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_quantity, 50) AS l_quantity, "
        "CAST(l_quantity = 50 AS INTEGER) AS l_quantity_was_sentinel FROM lineitem",
    ),
    "null_policy": (
        lambda t: conform.null_policy(
            t.labelled.select("doc_id", "quality", "toxic"), {"quality": "flag", "toxic": "zero", "doc_id": "keep"}
        ),
        "SELECT doc_id, quality, coalesce(toxic, 0) AS toxic, CAST(quality IS NULL AS INTEGER) AS quality_is_null "
        f"FROM {LABELLED}",
    ),
    "dedup_latest": (
        lambda t: conform.dedup(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]),
        "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
        "l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
        "l_linestatus) = 1",
    ),
    "dedup_rare": (
        lambda t: conform.dedup_rare(
            t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey"], [F.col("l_shipdate").desc()]
        ),
        "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY "
        "l_shipdate DESC, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
        "l_linestatus) = 1",
    ),
    "dedup_null_keys": (
        lambda t: conform.dedup(
            t.lineitem.select(F.nullif("l_suppkey", F.lit(7)).alias("k"), "l_partkey", "l_shipdate"), ["k"]
        ),
        "SELECT * FROM (SELECT nullif(l_suppkey, 7) AS k, l_partkey, l_shipdate FROM lineitem) "
        "QUALIFY k IS NULL OR row_number() OVER (PARTITION BY k ORDER BY l_partkey, l_shipdate) = 1",
    ),
    "drop_full_duplicates": (
        lambda t: conform.drop_full_duplicates(t.lineitem.select("l_suppkey", "l_linenumber", "l_returnflag")),
        "SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag FROM lineitem",
    ),
    "drop_full_duplicates_rare": (
        lambda t: conform.drop_full_duplicates_rare(t.events.select("user_id", "event_type", "value")),
        "SELECT DISTINCT user_id, event_type, value FROM events",
    ),
    "unify_splits": (
        lambda t: conform.unify_applications(
            t.customer.where("c_mktsegment <> 'BUILDING'"), _building(t).drop("c_acctbal"), target="c_acctbal"
        ),
        "SELECT * REPLACE (CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal), "
        "CAST(c_mktsegment <> 'BUILDING' AS INTEGER) AS is_train FROM customer",
    ),
    "age_years": (
        lambda t: conform.add_age(
            t.orders.select("o_orderkey", days("o_orderdate").alias("offset_days")), "offset_days", "age"
        ),
        f"SELECT o_orderkey, CAST({days_sql('o_orderdate')} AS INTEGER) AS offset_days, "
        f"round(-{days_sql('o_orderdate')} / 365.25, 6) AS age FROM orders",
    ),
    "ratio": (
        lambda t: conform.add_ratio(
            t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax"),
            "l_extendedprice",
            "l_tax",
            "price_to_tax",
        ),
        "SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax, "
        "CASE WHEN l_tax <> 0 THEN l_extendedprice / l_tax END AS price_to_tax FROM lineitem",
    ),
    "grant_gap": (
        lambda t: conform.add_grant_gap(
            t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"),
            "l_extendedprice",
            "l_quantity",
        ),
        "SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_extendedprice - l_quantity AS grant_gap "
        "FROM lineitem",
    ),
    "payment_delay": (
        lambda t: conform.add_payment_delay(
            t.order_lines.select(
                "o_orderkey",
                "l_linenumber",
                days("o_orderdate").alias("due"),
                days("l_shipdate").alias("shipped"),
                "l_extendedprice",
            ),
            "due",
            "shipped",
            "l_extendedprice",
        ),
        "SELECT *, shipped - due AS payment_delay, CAST(coalesce(shipped > due, false) AS INTEGER) AS is_late, "
        "CAST(l_extendedprice IS NULL AS INTEGER) AS is_missed FROM "
        f"(SELECT o_orderkey, l_linenumber, CAST({days_sql('o_orderdate')} AS INTEGER) AS due, "
        f"CAST({days_sql('l_shipdate')} AS INTEGER) AS shipped, l_extendedprice FROM {ORDER_LINES})",
    ),
    "status_severity": (
        lambda t: conform.add_status_severity(
            t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"),
            "l_returnflag",
            clean=("N",),
            past_due=("A",),
        ),
        "SELECT l_orderkey, l_linenumber, l_returnflag, "
        "CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 END AS status_severity, "
        "CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END AS is_delinquent FROM lineitem",
    ),
    "block_mean": (
        lambda t: rounded(conform.building_block(_block(t), BLOCK, "block"), 6, "block_mean"),
        "SELECT *, round(list_avg([q, d, t]), 6) AS block_mean, "
        "CAST(len(list_filter([q, d, t], lambda x: x IS NOT NULL)) AS INTEGER) AS block_present FROM "
        "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_quantity, 50) AS q, "
        "nullif(l_discount, 0) AS d, nullif(l_tax, 0) AS t FROM lineitem)",
    ),
    "drop_mostly_null": (
        lambda t: conform.drop_mostly_null(_half_empty(t), 50.0),
        f"SELECT o_orderkey, l_linenumber, l_shipdate, flag FROM {HALF_EMPTY}",
    ),
    "null_report": (
        lambda t: conform.null_report(_half_empty(t)),
        "SELECT column_name, total_rows, null_count, "
        f"{sql.percent('null_count', 'total_rows')} AS pct_null FROM (SELECT count(*) AS total_rows, "
        "count(*) - count(COLUMNS(*)) FROM " + HALF_EMPTY + ") "
        "UNPIVOT (null_count FOR column_name IN (COLUMNS(* EXCLUDE total_rows)))",
    ),
}


# --- marts ---------------------------------------------------------------------------------


def _by_order(t: Tables) -> DataFrame:
    return marts.status_by_credit(t.lineitem, "l_orderkey", "l_returnflag", **LINE_CODES)


def _orders_with_lines(t: Tables) -> DataFrame:
    by_order = _by_order(t).withColumnRenamed("l_orderkey", "o_orderkey")
    orders = t.orders.withColumn("days_ordered", days("o_orderdate"))
    return marts.dim_bureau(
        orders,
        by_order,
        applicant="o_custkey",
        credit="o_orderkey",
        active="o_orderstatus",
        active_value="O",
        closed_value="F",
        debt="o_totalprice",
        day_overdue="o_totalprice",
        max_overdue="o_totalprice",
        days_credit="days_ordered",
    ).withColumn("bureau_debt_sum", F.round("bureau_debt_sum", 2))


def _event_agg(t: Tables) -> DataFrame:
    events = t.events.withColumn("whole", F.floor("value"))
    return mean_as_sum(
        marts.dim_pos_cash_agg(
            events,
            applicant="user_id",
            status="event_type",
            past_due="value",
            past_due_tolerant="whole",
            active_value="purchase",
            completed_value="signup",
        ),
        "pos_dpd_mean",
        "pos_month_count",
    )


def _fact(t: Tables) -> DataFrame:
    dims = {
        "orders": _orders_with_lines(t).withColumnRenamed("o_custkey", "c_custkey"),
        "events": _event_agg(t).withColumnRenamed("user_id", "c_custkey"),
    }
    base = t.customer.withColumn("TARGET", (F.col("c_acctbal") < 0).cast("int"))
    return marts.fact_application(base, dims, "c_custkey")


BY_ORDER = (
    "SELECT l_orderkey, count(*) AS month_count, max(CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END) "
    "AS worst_status, count(*) FILTER (WHERE l_returnflag <> 'N') AS delinquent_month_count, "
    "count(*) FILTER (WHERE l_returnflag <> 'N') / count(*) AS delinquent_share FROM lineitem GROUP BY l_orderkey"
)
BY_CUSTOMER = (
    "SELECT o_custkey, count(*) AS bureau_count, count(*) FILTER (WHERE o_orderstatus = 'O') AS bureau_active_count, "
    "count(*) FILTER (WHERE o_orderstatus = 'F') AS bureau_closed_count, "
    "round(sum(o_totalprice), 2) AS bureau_debt_sum, max(o_totalprice) AS bureau_day_overdue_max, "
    "max(o_totalprice) AS bureau_amt_overdue_max, "
    f"CAST(max({days_sql('o_orderdate')}) AS INTEGER) AS bureau_days_credit_latest, "
    "CAST(coalesce(sum(month_count), 0) AS BIGINT) AS bureau_month_count, "
    "max(worst_status) AS bureau_worst_status, "
    "sum(delinquent_month_count) / sum(month_count) AS bureau_delinquent_share "
    f"FROM orders LEFT JOIN ({BY_ORDER}) s ON l_orderkey = o_orderkey GROUP BY o_custkey"
)
BY_USER = (
    "SELECT user_id, count(*) AS pos_month_count, max(value) AS pos_dpd_max, round(sum(value), 2) AS pos_dpd_sum, "
    "CAST(max(floor(value)) AS BIGINT) AS pos_dpd_def_max, avg(floor(value)) AS pos_dpd_def_mean, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS pos_active_count, "
    "count(*) FILTER (WHERE event_type = 'signup') AS pos_completed_count FROM events GROUP BY user_id"
)
FACT = (
    "SELECT c.*, CAST(c_acctbal < 0 AS INTEGER) AS TARGET, "
    "coalesce(bureau_count, 0) AS bureau_count, coalesce(bureau_active_count, 0) AS bureau_active_count, "
    "coalesce(bureau_closed_count, 0) AS bureau_closed_count, bureau_debt_sum, bureau_day_overdue_max, "
    "bureau_amt_overdue_max, bureau_days_credit_latest, coalesce(bureau_month_count, 0) AS bureau_month_count, "
    "bureau_worst_status, bureau_delinquent_share, CAST(o_custkey IS NOT NULL AS INTEGER) AS has_orders_history, "
    "coalesce(pos_month_count, 0) AS pos_month_count, pos_dpd_max, pos_dpd_sum, pos_dpd_def_max, pos_dpd_def_mean, "
    "coalesce(pos_active_count, 0) AS pos_active_count, coalesce(pos_completed_count, 0) AS pos_completed_count, "
    "CAST(user_id IS NOT NULL AS INTEGER) AS has_events_history "
    f"FROM customer c LEFT JOIN ({BY_CUSTOMER}) o ON o_custkey = c_custkey LEFT JOIN ({BY_USER}) e ON user_id = c_custkey"
)

MARTS: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {
    "worst_status_by_key": (_by_order, BY_ORDER),
    "dim_two_hop": (_orders_with_lines, BY_CUSTOMER),
    "dim_status_counts": (
        lambda t: mean_as_sum(
            marts.dim_previous_application(
                t.orders.withColumn("granted", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0)),
                applicant="o_custkey",
                status="o_orderstatus",
                reason="o_orderpriority",
                applied="o_totalprice",
                granted="granted",
                statuses={"open": ("O",), "filled": ("F",), "partial": ("P",)},
                reasons=("1-URGENT", "5-LOW"),
            ),
            "previous_grant_gap_mean",
            "previous_count",
        ),
        "SELECT o_custkey, count(*) AS previous_count, "
        + ", ".join(
            f"count(*) FILTER (WHERE o_orderstatus = '{v}') AS previous_{n}_count"
            for n, v in (("open", "O"), ("filled", "F"), ("partial", "P"))
        )
        + ", count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS previous_reason_1_urgent_count, "
        "count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS previous_reason_5_low_count, "
        "round(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END), 2) AS previous_grant_gap_sum "
        "FROM orders GROUP BY o_custkey",
    ),
    "dim_delay_agg": (
        lambda t: rounded(
            marts.dim_installments_agg(
                t.lines.withColumns(
                    {
                        "paid": F.when(F.col("l_returnflag") != "N", F.col("l_quantity")),
                        "prescribed": F.col("l_linenumber") * 10,
                    }
                ),
                applicant="o_custkey",
                due="due",
                paid_on="shipped",
                prescribed="prescribed",
                paid="paid",
            ),
            4,
            "instalment_delay_mean",
        ),
        "SELECT o_custkey, count(*) AS instalment_count, count(*) FILTER (WHERE l_returnflag = 'N') AS "
        "instalment_missed_count, count(*) FILTER (WHERE shipped > due) AS instalment_late_count, "
        "round(avg(shipped - due), 4) AS instalment_delay_mean, max(shipped - due) AS instalment_delay_max, "
        "CASE WHEN count(*) FILTER (WHERE l_returnflag <> 'N') > 0 THEN "
        "count(*) FILTER (WHERE l_returnflag <> 'N' AND l_quantity < 10 * l_linenumber) / "
        "count(*) FILTER (WHERE l_returnflag <> 'N') END AS instalment_underpaid_share, "
        "sum(l_quantity) FILTER (WHERE l_returnflag <> 'N') AS instalment_paid_sum "
        f"FROM {LINES} GROUP BY o_custkey",
    ),
    "dim_utilization": (
        lambda t: rounded(
            marts.dim_credit_card_agg(
                t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumns(
                    {"card_limit": F.floor("c_acctbal"), "drawings": F.length("o_orderpriority").cast("double")}
                ),
                applicant="o_custkey",
                amount="o_totalprice",
                limit="card_limit",
                atm_drawings="drawings",
                past_due="c_nationkey",
            ),
            4,
            "card_utilization_mean",
        ),
        "SELECT o_custkey, count(*) AS card_month_count, "
        "round(avg(o_totalprice / nullif(floor(c_acctbal), 0)), 4) AS card_utilization_mean, "
        "max(o_totalprice / nullif(floor(c_acctbal), 0)) AS card_utilization_max, "
        "CAST(sum(length(o_orderpriority)) AS BIGINT) AS card_atm_drawing_count, max(c_nationkey) AS card_dpd_max "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey",
    ),
    "dim_event_agg": (_event_agg, BY_USER),
    "fact_customer": (_fact, FACT),
}


# --- checks and reports --------------------------------------------------------------------


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.labelled.where("source < 'src4'"), t.labelled.where("source >= 'src4'")


def _perturbed(t: Tables) -> DataFrame:
    owner = F.when(F.col("l_tax") == 0, F.col("l_suppkey")).otherwise(F.col("o_custkey"))
    return t.lines.select("l_orderkey", owner.alias("o_custkey"))


def _rules() -> list[checks.Rule]:
    return [
        checks.not_null("l_orderkey"),
        checks.in_range("l_quantity", 2, 49),
        checks.in_set("l_returnflag", ("A", "N")),
        checks.in_range("l_discount", high=0.05),
        checks.in_range("l_quantity", high=45),
    ]


def _expectations_sql() -> str:
    failing = {
        "not_null(l_orderkey)": "l_orderkey IS NULL",
        "in_range(l_quantity, 2..49)": "l_quantity < 2 OR l_quantity > 49",
        "in_set(l_returnflag)": "l_returnflag NOT IN ('A', 'N')",
        "in_range(l_discount, ..0.05)": "l_discount > 0.05",
        "in_range(l_quantity, ..45)": "l_quantity > 45",
    }
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {fails}) AS failed_count, count(*) AS total_rows "
        f"FROM {ORDER_LINES}"
        for rule, fails in failing.items()
    )


def _fk_sql() -> str:
    links = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("events", "user_id", "supplier", "s_suppkey"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS child, '{k}' AS key, '{p}' AS parents, count(*) AS orphan_count, "
        f"count(DISTINCT {k}) AS orphan_keys FROM {c} WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {pk} = {k})"
        for c, k, p, pk in links
    )


def _drift_side(side: str, condition: str) -> str:
    columns = ", ".join(
        [
            f"{sql.percent('(count(*) - count(quality))', 'count(*)')} AS pct_null_quality",
            sql.stats("n_chars", "n_chars"),
        ]
    )
    return (
        f"SELECT metric, {side} FROM (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM (SELECT {columns} FROM {LABELLED} "
        f"WHERE {condition})) UNPIVOT INCLUDE NULLS ({side} FOR metric IN (COLUMNS(*)))"
    )


BAND_SQL = "CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 2500 THEN 1 WHEN c_acctbal < 5000 THEN 2 WHEN c_acctbal < 7500 THEN 3 ELSE 4 END"
RISK_SQL = (
    "count(*) AS application_count, count(*) AS labelled_count, count(*) FILTER (WHERE {d}) AS default_count, "
    "count(*) FILTER (WHERE {d}) / count(*) AS default_rate"
)


def _poor(t: Tables) -> DataFrame:
    """The fact with a label independent of the balance bands."""
    return _fact(t).withColumn("TARGET", (F.col("c_nationkey") < 5).cast("int"))


CHECKS: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {
    "expectations": (lambda t: checks.expectations(t.order_lines, _rules()), _expectations_sql()),
    "unique_check": (
        lambda t: checks.unique_check(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey"]),
        "SELECT *, duplicate_key_combo = 0 AS is_unique FROM "
        f"({sql.key_profile('lineitem', ['l_orderkey', 'l_linenumber', 'l_partkey'])})",
    ),
    "fk_report": (
        lambda t: checks.fk_report(
            {n: getattr(t, n) for n in ("lineitem", "orders", "customer", "events", "supplier")},
            [
                checks.Link("lineitem", "l_orderkey", ("orders",), "o_orderkey"),
                checks.Link("orders", "o_custkey", ("customer",), "c_custkey"),
                checks.Link("events", "user_id", ("supplier",), "s_suppkey"),
            ],
        ),
        _fk_sql(),
    ),
    "path_agreement": (
        lambda t: checks.path_agreement(_perturbed(t), t.orders, "l_orderkey", "o_custkey", "o_orderkey"),
        "SELECT count(*) AS compared_count, count(*) FILTER (WHERE l_tax = 0 AND l_suppkey <> o_custkey) "
        f"AS disagreement_count FROM {LINES}",
    ),
    "category_drift": (
        lambda t: checks.category_drift(*_halves(t), ["source", "lang"], unseen_only=False),
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value, count(*) FILTER (WHERE source < 'src4') AS train_count, "
            f"count(*) FILTER (WHERE source >= 'src4') AS test_count FROM documents GROUP BY {c}"
            for c in ("source", "lang")
        ),
    ),
    "category_drift_unseen": (
        lambda t: checks.category_drift(*_halves(t), ["source", "lang"]),
        "SELECT 'source' AS column_name, source AS value, count(*) FILTER (WHERE source < 'src4') AS train_count, "
        "count(*) FILTER (WHERE source >= 'src4') AS test_count FROM documents GROUP BY source",
    ),
    "profile_drift": (
        lambda t: rounded(
            checks.profile_drift(*_halves(t), ["quality"], [profile.Measure("n_chars", "n_chars")]),
            4,
            "train_value",
            "test_value",
            "delta",
        ),
        "SELECT metric, round(train_value, 4) AS train_value, round(test_value, 4) AS test_value, "
        f"round(test_value - train_value, 4) AS delta FROM ({_drift_side('train_value', "source < 'src4'")}) "
        f"JOIN ({_drift_side('test_value', "source >= 'src4'")}) USING (metric)",
    ),
    "row_preservation": (
        lambda t: checks.row_preservation(_fact(t), t.customer, "c_custkey"),
        "SELECT b.n AS base_rows, f.n AS fact_rows, b.k AS base_keys, f.k AS fact_keys, "
        "b.n = f.n AND b.k = f.k AS is_preserved FROM "
        "(SELECT count(*) AS n, count(DISTINCT c_custkey) AS k FROM customer) b, "
        f"(SELECT count(*) AS n, count(DISTINCT c_custkey) AS k FROM ({FACT})) f",
    ),
    "reconcile_counts": (
        lambda t: checks.reconcile_counts(t.customer, _fact(t)),
        "SELECT *, source_rows = target_rows AS is_equal FROM (SELECT count(*) AS source_rows FROM customer), "
        f"(SELECT count(*) AS target_rows FROM ({FACT}))",
    ),
    "risk_by_segment": (
        lambda t: reports.risk_by_segment(_fact(t), "c_mktsegment"),
        f"SELECT c_mktsegment, {RISK_SQL.format(d='c_acctbal < 0')} FROM customer GROUP BY c_mktsegment",
    ),
    "default_rate_by_band": (
        lambda t: reports.default_rate_by_band(_poor(t), "c_acctbal", BANDS),
        f"SELECT {BAND_SQL} AS band, ['< 0', '0 - 2500', '2500 - 5000', '5000 - 7500', '>= 7500'][{BAND_SQL} + 1] "
        f"AS band_label, {RISK_SQL.format(d='c_nationkey < 5')} FROM customer GROUP BY ALL",
    ),
    "customer_detail": (
        lambda t: reports.applicant_detail(_fact(t), 7, "c_custkey"),
        f"SELECT * FROM ({FACT}) WHERE c_custkey = 7",
    ),
}


# --- sources and jobs ----------------------------------------------------------------------


def _ingest_roundtrip(t: Tables) -> DataFrame:
    """Orders landed as Parquet, ingested to a bronze table by a job, and read back."""
    root = work_dir(t.spark)
    spec = TableSpec("orders_roundtrip", landing_root=root, schema_prefix="trial_")
    land(t.orders, root, spec.table)
    ensure_schemas(t.spark, layers=["bronze"], prefix="trial_", location=root)
    BronzeJob(t.spark, spec).run()
    return t.spark.table(spec.target_table)


def _as_csv(t: Tables) -> str:
    """Orders as CSV files with headers: commas and quotes in a text column, an empty and a NULL text."""
    folder = f"{work_dir(t.spark)}/orders_csv"
    note = "CASE o_orderkey % 5 WHEN 0 THEN 'a, \"b\"' WHEN 1 THEN '' WHEN 2 THEN 'NA' WHEN 3 THEN o_orderstatus END"
    rows = t.orders.selectExpr(
        "o_orderkey AS SK_ID_PREV", "o_custkey AS SK_ID_CURR", "o_totalprice AS AMT_CREDIT",
        "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS BIGINT) END AS CNT_PAYMENT", f"{note} AS NOTE",
        "o_orderstatus = 'F' AS CLOSED",
    )
    rows.repartition(3).write.option("header", True).option("escape", '"').option("emptyValue", '""').csv(folder)
    return folder


_CSV_SQL = (
    "SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR, o_totalprice AS AMT_CREDIT, "
    "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(trunc(o_totalprice) AS DOUBLE) END AS CNT_PAYMENT, "
    "CASE o_orderkey % 5 WHEN 0 THEN 'a, \"b\"' WHEN 1 THEN '' WHEN 2 THEN 'NA' WHEN 3 THEN o_orderstatus END AS NOTE, "
    "{closed} AS CLOSED FROM orders"
)


def _csv_roundtrip(t: Tables) -> DataFrame:
    """CSV files loaded into a table, types by name."""
    folder = _as_csv(t)
    ensure_schemas(t.spark, layers=["bronze"], prefix="csv_", location=folder.rpartition("/")[0])
    csv_to_table(t.spark, folder, "spark_catalog.csv_bronze.orders")
    return t.spark.table("spark_catalog.csv_bronze.orders")


def _quarantine(t: Tables) -> DataFrame:
    """Lines divided into sound and rejected ones in one pass, read back with their reasons."""
    root = work_dir(t.spark)
    ensure_schemas(t.spark, layers=["silver"], prefix="parted_", location=root)
    price = F.when(F.col("l_linenumber") == 3, F.col("l_extendedprice")).otherwise(F.floor("l_extendedprice"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", price.cast("double").alias("price"))
    rules = [checks.in_set("l_returnflag", ("A", "N")), checks.in_range("l_quantity", high=45)]
    name = "spark_catalog.parted_silver.lines"
    write_quarantined(lines, name, f"{root}/lines", {"price": "int"}, rules)
    kept = t.spark.table(name).withColumn("reject_reason", F.lit(None).cast("string"))
    return kept.unionByName(t.spark.table(f"{name}__rejected"))


SOURCES: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {
    "ingest_roundtrip": (_ingest_roundtrip, "SELECT * FROM orders"),
    "csv_roundtrip": (_csv_roundtrip, _CSV_SQL.format(closed="CAST(o_orderstatus = 'F' AS VARCHAR)")),
    "quarantine_lines": (
        _quarantine,
        "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, CASE WHEN l_linenumber <> 3 OR l_extendedprice = "
        "floor(l_extendedprice) THEN CAST(floor(l_extendedprice) AS INTEGER) END AS price, nullif(concat_ws('; ', "
        "CASE WHEN l_linenumber = 3 AND l_extendedprice <> floor(l_extendedprice) THEN 'cast(price)' END, "
        "CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'in_set(l_returnflag)' END, "
        "CASE WHEN l_quantity > 45 THEN 'in_range(l_quantity, ..45)' END), '') AS reject_reason FROM lineitem",
    ),
    "csv_inferred_types": (
        lambda t: read_csv(t.spark, _as_csv(t), infer=True), _CSV_SQL.format(closed="o_orderstatus = 'F'"),
    ),
}

ALL = {**PROFILE, **CONFORM, **MARTS, **CHECKS, **SOURCES}


def queries() -> dict[str, Query]:
    return {name: (lambda spark, sf_dir, build=build: build(Tables(spark, sf_dir))) for name, (build, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in ALL.items()}
