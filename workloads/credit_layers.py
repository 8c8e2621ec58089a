"""Conformed tables, star schema, checks and reports of the credit tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.operators import checks, marts, reports
from credit_marts.plans import pipeline
from credit_marts.plans.lazy import LazyTables
from credit_marts.plans.refresh import PART, refresh_fact
from credit_marts.sources import ensure_schemas, files_fingerprint, land, shuffles_freed, table_specs, work_dir, write_table
from workloads import credit_view
from workloads.credit_view import CreditTables, with_credit_tables
from workloads.native import mean_as_sum
from workloads.sql import percent

Query = Callable[[SparkSession, str], DataFrame]

REASONS = ("1-URGENT", "5-LOW", "XAP")
# The columns that the drift findings look at.
CATEGORIES = (
    "CODE_GENDER", "NAME_CONTRACT_TYPE", "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
    "NAME_HOUSING_TYPE",
)
NULLABLE = (
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "OCCUPATION_TYPE", "AMT_ANNUITY", "AMT_GOODS_PRICE", "NAME_TYPE_SUITE",
)
INCOME_BANDS = (0, 2500, 5000, 7500)
AGE_BANDS = (30, 45, 60)


def _rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Sums and means of amounts rounded, as their last digits depend on the order of addition.
    The mean grant gap is shown as a sum, whose cents never fall between two roundings."""
    if "previous_grant_gap_mean" in df.columns:
        df = mean_as_sum(df, "previous_grant_gap_mean", "previous_count")
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


DIGITS = {
    "building_mean": 8,
    "bureau_debt_sum": 2,
    "instalment_paid_sum": 4,
    "card_utilization_mean": 6,
}


def _silver(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return pipeline.silver_tables(CreditTables(spark, sf_dir))


def _silver_for_marts(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The conformed tables, of which the dimensions read some columns and the fact all of the applications."""
    return pipeline.silver_tables(CreditTables(spark, sf_dir), reads=pipeline.DIMENSION_READS)


def _silver_query(name: str) -> Query:
    return lambda spark, sf_dir: _rounded(_silver(spark, sf_dir)[name], DIGITS)


def _gold_query(name: str) -> Query:
    return lambda spark, sf_dir: _rounded(pipeline.gold_tables(_silver_for_marts(spark, sf_dir), REASONS)[name], DIGITS)


def _stored_dims_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over stored applications and dimensions, as the pipeline builds it: the dimensions run
    beside each other, and no plan holds more than one of them."""
    silver = _silver_for_marts(spark, sf_dir)
    dims = pipeline.gold_dimensions(silver, REASONS)
    parts = LazyTables({**{n: partial(dims.__getitem__, n) for n in dims}, "application": lambda: silver["application"]})
    stored = _stored(spark, parts, at_a_time=6)
    return marts.fact_application(stored["application"], {n: stored[n] for n in dims})


def _kept_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact stored for questions about single applicants: bucketed and sorted by them, with Bloom
    filters. It is stored by the first question and found by later ones, as long as no input file changes."""
    files = files_fingerprint(spark, sf_dir)
    name = f"spark_catalog.kept_gold.fact_{files}"
    if not spark.catalog.tableExists(name):
        ensure_schemas(spark, layers=("gold",), prefix="kept_", location=work_dir(spark))
        write_table(_stored_dims_fact(spark, sf_dir), name, buckets=(8, "SK_ID_CURR"), lookup="SK_ID_CURR")
    return spark.table(name)


def _refreshed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact stored while a twentieth of the applicants had other cards, then refreshed by parts."""
    silver, root = _silver_for_marts(spark, sf_dir), work_dir(spark)
    dims = pipeline.gold_dimensions(silver, REASONS)
    lazy = LazyTables({**{n: partial(dims.__getitem__, n) for n in dims}, "application": lambda: silver["application"]})
    inputs = _stored(spark, lazy, at_a_time=6)

    def build(tables: Mapping[str, DataFrame]) -> DataFrame:
        return marts.fact_application(tables["application"], {n: tables[n] for n in dims})

    old = inputs["credit_card_agg"].withColumn(
        "card_month_count", F.when(F.col("SK_ID_CURR") % 20 == 0, 0).otherwise(F.col("card_month_count"))
    )
    name = f"spark_catalog.fresh_gold.fact_{root.rpartition('-')[2]}"
    ensure_schemas(spark, layers=("gold",), prefix="fresh_", location=root)
    refresh_fact(spark, name, {**inputs, "credit_card_agg": old}, build, parts=8)
    refresh_fact(spark, name, inputs, build, parts=8)
    return _rounded(spark.table(name).drop(PART), DIGITS)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.gold_tables(_silver_for_marts(spark, sf_dir), REASONS)["fact_application"]


def _int(column: str) -> str:
    """A whole number, NULL where there is a fraction."""
    return f"CASE WHEN {column} = floor({column}) THEN CAST({column} AS INTEGER) END"


def _ints(*columns: str) -> str:
    return ", ".join(f"{_int(c)} AS {c}" for c in columns)


def _ties(table: str, *special: str) -> str:
    """All columns of a table in order, values before NULL; ``special`` replaces some of them."""
    changed = dict(s.split(" AS ") for s in special)
    names = credit_view.columns(credit_view.duckdb_days)[table][2]
    return ", ".join(f"{changed.get(c, c)} ASC NULLS LAST" for c in names)


def _one(keys: str, order: str) -> str:
    """One row per key stays, the first in order; rows with an incomplete key all stay."""
    incomplete = " OR ".join(f"{k} IS NULL" for k in keys.split(", "))
    return f"QUALIFY {incomplete} OR row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


_NO_TARGET = "SELECT *, CAST(NULL AS BIGINT) AS TARGET, 0 AS is_train FROM application_test"

_DRAWN = ("AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT")

# The rule of survival of each table stands in its QUALIFY, in words of its own: a train row before
# a test row; a row with an applicant; the latest; the worst status or the most days past due.
SILVER_SQL = {
    "application": f"""
        SELECT * REPLACE ({_ints('CNT_CHILDREN', 'DAYS_BIRTH')},
                CAST(nullif(DAYS_EMPLOYED, 365243) AS INTEGER) AS DAYS_EMPLOYED),
            CAST(DAYS_EMPLOYED = 365243 AS INTEGER) AS DAYS_EMPLOYED_was_sentinel,
            CAST(EXT_SOURCE_1 IS NULL AS INTEGER) AS EXT_SOURCE_1_is_null,
            CAST(EXT_SOURCE_2 IS NULL AS INTEGER) AS EXT_SOURCE_2_is_null,
            CAST(EXT_SOURCE_3 IS NULL AS INTEGER) AS EXT_SOURCE_3_is_null,
            round(-DAYS_BIRTH / 365.25, 6) AS age_years,
            CASE WHEN AMT_INCOME_TOTAL <> 0 THEN AMT_CREDIT / AMT_INCOME_TOTAL END AS debt_burden,
            round(list_avg([APARTMENTS_AVG, LIVINGAREA_AVG, ELEVATORS_AVG, APARTMENTS_MODE, LIVINGAREA_MEDI]), 8)
                AS building_mean,
            CAST((APARTMENTS_AVG IS NOT NULL)::INT + (LIVINGAREA_AVG IS NOT NULL)::INT
                + (ELEVATORS_AVG IS NOT NULL)::INT + (APARTMENTS_MODE IS NOT NULL)::INT
                + (LIVINGAREA_MEDI IS NOT NULL)::INT AS INTEGER) AS building_present
        FROM (
            SELECT * FROM (SELECT *, 1 AS is_train FROM application_train UNION ALL BY NAME {_NO_TARGET})
            {_one("SK_ID_CURR", "is_train DESC, " + _ties("application_train", "nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED"))}
        )""",
    "bureau": f"SELECT * REPLACE ({_ints('DAYS_CREDIT', 'DAYS_CREDIT_ENDDATE')}) FROM (SELECT * FROM bureau "
    + _one(
        "SK_ID_BUREAU",
        "(SK_ID_CURR IS NULL), DAYS_CREDIT DESC NULLS LAST, CREDIT_DAY_OVERDUE DESC NULLS LAST, "
        + _ties("bureau", "CASE WHEN DAYS_CREDIT_ENDDATE = floor(DAYS_CREDIT_ENDDATE) THEN DAYS_CREDIT_ENDDATE END AS DAYS_CREDIT_ENDDATE"),
    )
    + ")",
    "bureau_balance": f"SELECT * REPLACE ({_ints('MONTHS_BALANCE')}), "
    "CASE WHEN STATUS IN ('C', '0') THEN 0 WHEN STATUS <> 'X' THEN CAST(STATUS AS INTEGER) END AS status_severity, "
    "CAST(STATUS IN ('1', '2', '3', '4', '5') AS INTEGER) AS is_delinquent FROM (SELECT * FROM bureau_balance "
    + _one(
        "SK_ID_BUREAU, MONTHS_BALANCE",
        "CASE STATUS WHEN '5' THEN 0 WHEN '4' THEN 1 WHEN '3' THEN 2 WHEN '2' THEN 3 WHEN '1' THEN 4 "
        "WHEN 'X' THEN 6 ELSE 5 END, STATUS",
    )
    + ")",
    "previous_application": f"SELECT * REPLACE ({_ints('DAYS_DECISION', 'CNT_PAYMENT')}, "
    "CAST(nullif(DAYS_FIRST_DRAWING, 365243) AS INTEGER) AS DAYS_FIRST_DRAWING), "
    "CAST(coalesce(DAYS_FIRST_DRAWING = 365243, false) AS INTEGER) AS DAYS_FIRST_DRAWING_was_sentinel, "
    "AMT_APPLICATION - AMT_CREDIT AS grant_gap FROM (SELECT * FROM previous_application "
    + _one(
        "SK_ID_PREV",
        "(SK_ID_CURR IS NULL), DAYS_DECISION DESC NULLS LAST, AMT_APPLICATION DESC NULLS LAST, "
        + _ties("previous_application", "nullif(DAYS_FIRST_DRAWING, 365243) AS DAYS_FIRST_DRAWING"),
    )
    + ")",
    "POS_CASH_balance": f"SELECT * REPLACE ({_ints('MONTHS_BALANCE', 'CNT_INSTALMENT', 'CNT_INSTALMENT_FUTURE')}) "
    "FROM (SELECT * FROM POS_CASH_balance "
    + _one(
        "SK_ID_PREV, MONTHS_BALANCE",
        "SK_DPD DESC NULLS LAST, SK_DPD_DEF DESC NULLS LAST, (SK_ID_CURR IS NULL), " + _ties("POS_CASH_balance"),
    )
    + ")",
    "credit_card_balance": "SELECT *, CASE WHEN AMT_CREDIT_LIMIT_ACTUAL <> 0 THEN AMT_BALANCE / "
    f"AMT_CREDIT_LIMIT_ACTUAL END AS utilization FROM (SELECT * REPLACE ({_ints('MONTHS_BALANCE')}, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _DRAWN)
    + ", CAST(coalesce(CNT_DRAWINGS_ATM_CURRENT, 0) AS INTEGER) AS CNT_DRAWINGS_ATM_CURRENT) "
    "FROM (SELECT * FROM credit_card_balance "
    + _one(
        "SK_ID_PREV, MONTHS_BALANCE",
        "SK_DPD DESC NULLS LAST, AMT_BALANCE DESC NULLS LAST, (SK_ID_CURR IS NULL), "
        + _ties("credit_card_balance", *[f"coalesce({c}, 0) AS {c}" for c in (*_DRAWN, "CNT_DRAWINGS_ATM_CURRENT")]),
    )
    + "))",
    "installments_payments": "SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS payment_delay, "
    "CAST(coalesce(DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT, false) AS INTEGER) AS is_late, "
    "CAST(AMT_PAYMENT IS NULL AS INTEGER) AS is_missed, "
    "CASE WHEN AMT_INSTALMENT <> 0 THEN AMT_PAYMENT / AMT_INSTALMENT END AS paid_share FROM "
    f"(SELECT DISTINCT * REPLACE ({_ints('DAYS_INSTALMENT', 'DAYS_ENTRY_PAYMENT')}) FROM installments_payments)",
}

GOLD_SQL = {
    "dim_bureau": """
        SELECT SK_ID_CURR, count(*) AS bureau_count,
            count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active') AS bureau_active_count,
            count(*) FILTER (WHERE CREDIT_ACTIVE = 'Closed') AS bureau_closed_count,
            round(sum(AMT_CREDIT_SUM_DEBT), 2) AS bureau_debt_sum,
            max(CREDIT_DAY_OVERDUE) AS bureau_day_overdue_max,
            max(AMT_CREDIT_MAX_OVERDUE) AS bureau_amt_overdue_max,
            max(DAYS_CREDIT) AS bureau_days_credit_latest,
            CAST(coalesce(sum(months), 0) AS BIGINT) AS bureau_month_count,
            max(worst) AS bureau_worst_status,
            sum(late) / sum(months) AS bureau_delinquent_share
        FROM s_bureau LEFT JOIN (
            SELECT SK_ID_BUREAU, count(*) AS months, max(status_severity) AS worst, sum(is_delinquent) AS late
            FROM s_bureau_balance GROUP BY SK_ID_BUREAU) USING (SK_ID_BUREAU)
        WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR""",
    "dim_previous_application": """
        SELECT SK_ID_CURR, count(*) AS previous_count,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') AS previous_approved_count,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Refused') AS previous_refused_count,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Canceled') AS previous_cancelled_count,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Unused offer') AS previous_unused_count,
            count(*) FILTER (WHERE CODE_REJECT_REASON = '1-URGENT') AS previous_reason_1_urgent_count,
            count(*) FILTER (WHERE CODE_REJECT_REASON = '5-LOW') AS previous_reason_5_low_count,
            count(*) FILTER (WHERE CODE_REJECT_REASON = 'XAP') AS previous_reason_xap_count,
            round(sum(grant_gap), 2) AS previous_grant_gap_sum
        FROM s_previous_application GROUP BY SK_ID_CURR""",
    "dim_installments_agg": """
        SELECT SK_ID_CURR, count(*) AS instalment_count, CAST(sum(is_missed) AS BIGINT) AS instalment_missed_count,
            CAST(sum(is_late) AS BIGINT) AS instalment_late_count, avg(payment_delay) AS instalment_delay_mean,
            max(payment_delay) AS instalment_delay_max,
            count(*) FILTER (WHERE AMT_PAYMENT < AMT_INSTALMENT) / nullif(count(AMT_PAYMENT), 0)
                AS instalment_underpaid_share,
            round(sum(AMT_PAYMENT), 4) AS instalment_paid_sum
        FROM s_installments_payments GROUP BY SK_ID_CURR""",
    "dim_credit_card_agg": """
        SELECT SK_ID_CURR, count(*) AS card_month_count, round(avg(utilization), 6) AS card_utilization_mean,
            max(utilization) AS card_utilization_max,
            CAST(sum(CNT_DRAWINGS_ATM_CURRENT) AS BIGINT) AS card_atm_drawing_count, max(SK_DPD) AS card_dpd_max
        FROM s_credit_card_balance WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR""",
    "dim_pos_cash_agg": """
        SELECT SK_ID_CURR, count(*) AS pos_month_count, max(SK_DPD) AS pos_dpd_max, avg(SK_DPD) AS pos_dpd_mean,
            max(SK_DPD_DEF) AS pos_dpd_def_max, avg(SK_DPD_DEF) AS pos_dpd_def_mean,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Active') AS pos_active_count,
            count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Completed') AS pos_completed_count
        FROM s_POS_CASH_balance GROUP BY SK_ID_CURR""",
}


def _fact_sql() -> str:
    joins, columns = [], []
    for name in GOLD_SQL:
        joins.append(f"LEFT JOIN {name} USING (SK_ID_CURR)")
        columns.append(
            f"{name}.* EXCLUDE (SK_ID_CURR) REPLACE (" + ", ".join(
                f"coalesce({c}, 0) AS {c}" for c in _counts(name)
            ) + f"), CAST({name}.{_counts(name)[0]} IS NOT NULL AS INTEGER) AS has_{name.removeprefix('dim_')}_history"
        )
    return f"SELECT a.*, {', '.join(columns)} FROM s_application a {' '.join(joins)}"


def _counts(dim: str) -> list[str]:
    words = GOLD_SQL[dim].replace(",", " ").split()
    return [w for w in words if w.endswith("_count") and not w.startswith("(")]


def _layered(select: str) -> str:
    """The counterpart with the layers it reads in front."""
    silver = [f"s_{n} AS ({s})" for n, s in SILVER_SQL.items()]
    gold = [f"{n} AS ({s})" for n, s in GOLD_SQL.items()]
    fact = [f"fact_application AS ({_fact_sql()})"]
    layers = ",\n".join(silver + gold + fact)
    with_bronze = with_credit_tables(f"{layers}\n{select}")
    head, tail = with_bronze.split(f"\n{layers}\n")
    return f"{head},\n{layers}\n{tail}"


def _quality_sql() -> str:
    applications = ("application",)
    previous = ("previous_application",)
    links = [
        ("bureau", "SK_ID_CURR", applications),
        ("bureau_balance", "SK_ID_BUREAU", ("bureau",)),
        ("previous_application", "SK_ID_CURR", applications),
        ("credit_card_balance", "SK_ID_PREV", previous),
        ("credit_card_balance", "SK_ID_CURR", applications),
        ("POS_CASH_balance", "SK_ID_PREV", previous),
        ("POS_CASH_balance", "SK_ID_CURR", applications),
        ("installments_payments", "SK_ID_PREV", previous),
        ("installments_payments", "SK_ID_CURR", applications),
    ]
    parts = [
        f"SELECT 'reference' AS check_name, '{child}' AS table_name, '{key} -> {parent}' AS detail, "
        f"count(*) AS failed_count FROM s_{child} c WHERE NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE p.{key} = c.{key})"
        for child, key, (parent,) in links
    ]
    whole = "(SELECT * FROM application_train UNION ALL BY NAME SELECT * FROM application_test)"
    day_columns = {"DAYS_EMPLOYED", "DAYS_FIRST_DRAWING"}
    for table, keys in {**pipeline.SILVER_KEYS, "installments_payments": pipeline.INSTALMENT_KEY}.items():
        raw = whole if table == "application" else table
        for c in credit_view.columns(credit_view.duckdb_days)[table if raw == table else "application_train"][2]:
            if re.match("(DAYS|CNT|MONTHS)_", c):
                value = f"nullif({c}, 365243)" if c in day_columns else c
                parts.append(
                    f"SELECT 'rejected', '{table}', '{c}', count(*) FILTER (WHERE {value} <> floor({value})) FROM {raw}"
                )
        parts.append(
            f"SELECT 'dropped', '{table}', 'duplicates', "
            f"(SELECT count(*) FROM {raw}) - (SELECT count(*) FROM s_{table})"
        )
        parts.append(
            f"SELECT 'unique', '{table}', '{','.join(keys)}', CAST(sum(CASE WHEN "
            f"{' OR '.join(f'{k} IS NULL' for k in keys)} THEN n ELSE n - 1 END) AS BIGINT) "
            f"FROM (SELECT {', '.join(keys)}, count(*) AS n FROM {raw} GROUP BY ALL)"
        )
    for c in CATEGORIES:
        parts.append(
            f"SELECT 'category_drift', 'application', '{c}', count(*) FROM (SELECT {c} FROM {whole} GROUP BY {c}) v "
            f"WHERE NOT EXISTS (SELECT 1 FROM application_train t WHERE t.{c} IS NOT DISTINCT FROM v.{c}) "
            f"OR NOT EXISTS (SELECT 1 FROM application_test t WHERE t.{c} IS NOT DISTINCT FROM v.{c})"
        )
    shares = " + ".join(
        f"CAST(abs((SELECT 100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) FROM application_train) - "
        f"(SELECT 100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) FROM application_test)) >= 5 AS BIGINT)"
        for c in NULLABLE
    )
    parts.append(f"SELECT 'null_rate_drift', 'application', '5 points', {shares}")
    for table in pipeline.TWO_ROUTES:
        parts.append(
            f"SELECT 'route', '{table}', 'SK_ID_CURR', count(*) FROM s_{table} c JOIN s_previous_application p "
            "USING (SK_ID_PREV) WHERE c.SK_ID_CURR IS DISTINCT FROM p.SK_ID_CURR"
        )
    return " UNION ALL ".join(parts)


def _stored(spark: SparkSession, tables: Mapping[str, DataFrame], at_a_time: int = 4) -> dict[str, DataFrame]:
    """Tables written and read again, as the pipeline does between its layers."""
    root = work_dir(spark)

    def one(name: str) -> tuple[str, DataFrame]:
        df = tables[name]
        df.write.parquet(f"{root}/{name}")
        return name, spark.read.schema(df.schema).parquet(f"{root}/{name}")

    with ThreadPoolExecutor(max_workers=at_a_time) as pool:
        return dict(pool.map(one, tables))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of the pipeline on its own tables, raw and stored conformed ones; of these the columns it reads."""
    raw = CreditTables(spark, sf_dir)
    return pipeline.quality_report(_stored(spark, pipeline.report_tables(raw)), raw)


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = CreditTables(spark, sf_dir)
    columns = ["NAME_INCOME_TYPE", "CODE_GENDER", "NAME_TYPE_SUITE"]
    return checks.category_drift(tables["application_train"], tables["application_test"], columns)


def _drift_sql() -> str:
    per_column = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, TARGET IS NOT NULL AS train FROM "
        "(SELECT * FROM application_train UNION ALL BY NAME SELECT * FROM application_test)"
        for c in ("NAME_INCOME_TYPE", "CODE_GENDER", "NAME_TYPE_SUITE")
    )
    return (
        "SELECT column_name, value, count(*) FILTER (WHERE train) AS train_count, "
        f"count(*) FILTER (WHERE NOT train) AS test_count FROM ({per_column}) GROUP BY column_name, value "
        "HAVING count(*) FILTER (WHERE train) = 0 OR count(*) FILTER (WHERE NOT train) = 0"
    )


RISK_SQL = (
    "count(*) AS application_count, count(TARGET) AS labelled_count, count(*) FILTER (WHERE TARGET = 1) AS "
    "default_count, count(*) FILTER (WHERE TARGET = 1) / nullif(count(TARGET), 0) AS default_rate"
)


def _band_sql(column: str, edges: tuple[int, ...]) -> str:
    number = f"CAST(len(list_filter({list(edges)}, lambda e: {column} >= e)) AS INTEGER)"
    inner = [f"{low} - {high}" for low, high in zip(edges, edges[1:])]
    labels = [f"< {edges[0]}", *inner, f">= {edges[-1]}"]
    return (
        f"SELECT band, {labels}[band + 1] AS band_label, {RISK_SQL} "
        f"FROM (SELECT *, {number} AS band FROM s_application) GROUP BY band"
    )


def _all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing, bronze, silver and gold as stored tables by one call; returns the stored fact."""
    root = work_dir(spark)
    tables = CreditTables(spark, sf_dir)
    with shuffles_freed(spark):
        for name, df in tables.items():
            land(df, root, name)
    ensure_schemas(spark, prefix="trial_", location=root)
    pipeline.run_pipeline(spark, table_specs(root, schema_prefix="trial_"), reasons=REASONS, buckets=8, at_a_time=4)
    return _rounded(spark.table("spark_catalog.trial_gold.fact_application"), DIGITS)


def queries() -> dict[str, Query]:
    found = {f"silver_{name.lower()}": _silver_query(name) for name in SILVER_SQL}
    found |= {f"gold_{name}": _gold_query(name) for name in GOLD_SQL}
    return found | {
        "gold_fact_application": lambda spark, sf_dir: _rounded(_stored_dims_fact(spark, sf_dir), DIGITS),
        "quality_report": _quality,
        "fact_refresh": _refreshed_fact,
        "application_category_drift": _drift,
        "risk_by_income_type": lambda spark, sf_dir: reports.risk_by_segment(
            _silver(spark, sf_dir)["application"], "NAME_INCOME_TYPE"
        ),
        "default_rate_by_income": lambda spark, sf_dir: reports.default_rate_by_band(
            _fact(spark, sf_dir), "AMT_INCOME_TOTAL", INCOME_BANDS
        ),
        "default_rate_by_age": lambda spark, sf_dir: reports.default_rate_by_band(
            _fact(spark, sf_dir), "age_years", AGE_BANDS
        ),
        "applicant_detail": lambda spark, sf_dir: _rounded(
            reports.applicant_detail(_kept_fact(spark, sf_dir), 42), DIGITS
        ),
        "layers_end_to_end": _all_layers,
    }


def oracle_sql() -> dict[str, str]:
    found = {f"silver_{n.lower()}": f"SELECT * FROM s_{n}" for n in SILVER_SQL}
    found |= {f"gold_{n}": f"SELECT * FROM {n}" for n in [*GOLD_SQL, "fact_application"]}
    found |= {
        "quality_report": _quality_sql(),
        "application_category_drift": _drift_sql(),
        "risk_by_income_type": f"SELECT NAME_INCOME_TYPE, {RISK_SQL} FROM s_application GROUP BY NAME_INCOME_TYPE",
        "default_rate_by_income": _band_sql("AMT_INCOME_TOTAL", INCOME_BANDS),
        "default_rate_by_age": _band_sql("age_years", AGE_BANDS),
        "applicant_detail": "SELECT * FROM fact_application WHERE SK_ID_CURR = 42",
        "layers_end_to_end": "SELECT * FROM fact_application",
        "fact_refresh": "SELECT * FROM fact_application",
    }
    return {name: _layered(text) for name, text in found.items()}
