"""The credit tables through all layers: conformed tables, quality report, star schema."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.operators import checks, conform, marts
from credit_marts.plans.jobs import GoldJob, SilverJob, ingest_all
from credit_marts.plans.lazy import LazyTables
from credit_marts.plans.profiles import DAYS_SENTINEL, LINKS, profiles
from credit_marts.sources import (
    RunLedger,
    TableSpec,
    ensure_schemas,
    files_fingerprint,
    fingerprint,
    land,
    shuffles_freed,
    work_dir,
)

# Natural keys of the conformed tables. Installments have none (see below).
SILVER_KEYS = {
    "application": ("SK_ID_CURR",),
    "bureau": ("SK_ID_BUREAU",),
    "bureau_balance": ("SK_ID_BUREAU", "MONTHS_BALANCE"),
    "previous_application": ("SK_ID_PREV",),
    "POS_CASH_balance": ("SK_ID_PREV", "MONTHS_BALANCE"),
    "credit_card_balance": ("SK_ID_PREV", "MONTHS_BALANCE"),
}

# The columns that identify an installment; several payments may share them.
INSTALMENT_KEY = ("SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "NUM_INSTALMENT_VERSION")

# Day columns in which a number stands for "no value".
SENTINELS = {"application": ("DAYS_EMPLOYED",), "previous_application": ("DAYS_FIRST_DRAWING",)}

# Tables that reach the applicant directly and through an earlier application.
TWO_ROUTES = ("POS_CASH_balance", "credit_card_balance", "installments_payments")

# The columns beside the keys that the quality report and the dimensions read of the
# conformed tables. Installments are compared in all columns whoever reads them.
REPORT_READS = {
    "application": (),
    "bureau": ("SK_ID_CURR",),
    "bureau_balance": (),
    "previous_application": ("SK_ID_CURR",),
    "POS_CASH_balance": ("SK_ID_CURR",),
    "credit_card_balance": ("SK_ID_CURR",),
    "installments_payments": ("SK_ID_PREV", "SK_ID_CURR"),
}
DIMENSION_READS = {
    "bureau": (
        "SK_ID_CURR", "CREDIT_ACTIVE", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE", "AMT_CREDIT_MAX_OVERDUE", "DAYS_CREDIT",
    ),
    "bureau_balance": ("STATUS",),
    "previous_application": (
        "SK_ID_CURR", "NAME_CONTRACT_STATUS", "CODE_REJECT_REASON", "AMT_APPLICATION", "AMT_CREDIT",
    ),
    "POS_CASH_balance": ("SK_ID_CURR", "NAME_CONTRACT_STATUS", "SK_DPD", "SK_DPD_DEF"),
    "credit_card_balance": (
        "SK_ID_CURR", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "CNT_DRAWINGS_ATM_CURRENT", "SK_DPD",
    ),
}

Dedup = Callable[..., DataFrame]


def offset_types(df: DataFrame) -> dict[str, str]:
    """Day and month offsets and counts are whole numbers, whatever type the source gave them."""
    return {c: "int" for c in df.columns if re.match(r"(DAYS|CNT|MONTHS)_", c)}


def _present(df: DataFrame, columns: Mapping[str, object]) -> dict:
    return {c: v for c, v in columns.items() if c in df.columns}


def _prepared(df: DataFrame, sentinels: Sequence[str] = (), policy: Mapping[str, str] | None = None) -> DataFrame:
    df = conform.sentinel_to_null(df, _present(df, dict.fromkeys(sentinels, DAYS_SENTINEL)))
    df = conform.standardize_types(df, offset_types(df))
    return conform.null_policy(df, _present(df, policy or {}))


def _first(df: DataFrame, *columns: str) -> list[Column]:
    """Which of several rows with one key stays: the one with the largest values, NULLs last."""
    return [F.col(c).desc_nulls_last() for c in columns if c in df.columns]


def _owned(column: str) -> Column:
    """Rows that name an applicant come before rows that do not."""
    return F.col(column).isNull()


def silver_application(train: DataFrame, test: DataFrame, dedup: Dedup = conform.dedup) -> DataFrame:
    """Both samples in one table with age, debt burden and the building block as one."""
    df = _prepared(
        conform.unify_applications(train, test),
        sentinels=SENTINELS["application"],
        policy=dict.fromkeys(("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"), "flag"),
    )
    df = dedup(df, SILVER_KEYS["application"], [F.col("is_train").desc()])
    df = conform.add_ratio(conform.add_age(df), "AMT_CREDIT", "AMT_INCOME_TOTAL", "debt_burden")
    block = conform.block_columns(df)
    return conform.building_block(df, block) if block else df


def silver_bureau(df: DataFrame, dedup: Dedup = conform.dedup) -> DataFrame:
    """Of rows with one credit id: one with an applicant, then the latest, then the most overdue."""
    df = _prepared(df)
    order = [_owned("SK_ID_CURR"), *_first(df, "DAYS_CREDIT", "CREDIT_DAY_OVERDUE")]
    return dedup(df, SILVER_KEYS["bureau"], order)


def silver_previous_application(df: DataFrame, dedup: Dedup = conform.dedup) -> DataFrame:
    """Of rows with one id: one with an applicant, then the latest decision."""
    df = _prepared(df, sentinels=SENTINELS["previous_application"])
    order = [_owned("SK_ID_CURR"), *_first(df, "DAYS_DECISION", "AMT_APPLICATION")]
    return conform.add_grant_gap(dedup(df, SILVER_KEYS["previous_application"], order))


def silver_bureau_balance(df: DataFrame, dedup: Dedup = conform.dedup) -> DataFrame:
    """Of two statuses of one month the worse one stays: it is the signal the marts measure."""
    df = conform.add_status_severity(_prepared(df))
    return dedup(df, SILVER_KEYS["bureau_balance"], _first(df, "status_severity"))


def silver_pos_cash_balance(df: DataFrame, dedup: Dedup = conform.dedup) -> DataFrame:
    """Of rows of one month: the most days past due."""
    df = _prepared(df)
    order = [*_first(df, "SK_DPD", "SK_DPD_DEF"), _owned("SK_ID_CURR")]
    return dedup(df, SILVER_KEYS["POS_CASH_balance"], order)


def silver_credit_card_balance(df: DataFrame, dedup: Dedup = conform.dedup) -> DataFrame:
    """No drawing recorded means nothing was drawn. Of rows of one month: the most days past due."""
    drawings = [c for c in df.columns if re.match(r"(AMT|CNT)_DRAWINGS_", c)]
    df = _prepared(df, policy=dict.fromkeys(drawings, "zero"))
    order = [*_first(df, "SK_DPD", "AMT_BALANCE"), _owned("SK_ID_CURR")]
    df = dedup(df, SILVER_KEYS["credit_card_balance"], order)
    return conform.add_ratio(df, "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "utilization")


def silver_installments(df: DataFrame, distinct: Dedup = conform.drop_full_duplicates) -> DataFrame:
    """One installment may be paid in several payments, so only full duplicates go, and missed
    payments stay NULL. ``paid_share`` is the part of the amount due that was paid."""
    df = conform.add_payment_delay(distinct(_prepared(df)))
    return conform.add_ratio(df, "AMT_PAYMENT", "AMT_INSTALMENT", "paid_share")


def silver_tables(
    bronze: Mapping[str, DataFrame],
    rare_duplicates: bool = False,
    reads: Mapping[str, Sequence[str]] | None = None,
) -> LazyTables:
    """All conformed tables. With ``rare_duplicates`` building a wide one runs a job that looks for
    its duplicates by key or hash, so that its rows are not exchanged for the few there are; the
    monthly statuses are nothing but key and status and gain nothing from that.

    ``reads`` names the columns beside the keys that the caller uses of a table; the others are then
    neither sorted nor exchanged for its deduplication, and must not be used."""

    def dedup(table: str, rare: bool = rare_duplicates) -> Dedup:
        chosen = conform.dedup_rare if rare else conform.dedup
        return partial(chosen, read=reads[table]) if reads and table in reads else chosen

    distinct = conform.drop_full_duplicates_rare if rare_duplicates else conform.drop_full_duplicates
    return LazyTables(
        {
            "application": lambda: silver_application(
                bronze["application_train"], bronze["application_test"], dedup("application")
            ),
            "bureau": lambda: silver_bureau(bronze["bureau"], dedup("bureau")),
            "bureau_balance": lambda: silver_bureau_balance(
                bronze["bureau_balance"], dedup("bureau_balance", rare=False)
            ),
            "previous_application": lambda: silver_previous_application(
                bronze["previous_application"], dedup("previous_application")
            ),
            "POS_CASH_balance": lambda: silver_pos_cash_balance(bronze["POS_CASH_balance"], dedup("POS_CASH_balance")),
            "credit_card_balance": lambda: silver_credit_card_balance(
                bronze["credit_card_balance"], dedup("credit_card_balance")
            ),
            "installments_payments": lambda: silver_installments(bronze["installments_payments"], distinct),
        }
    )


def report_tables(bronze: Mapping[str, DataFrame]) -> LazyTables:
    """The conformed tables with the columns that the quality report reads of them, all their rows."""
    silver = silver_tables(bronze, reads=REPORT_READS)

    def one(name: str) -> DataFrame:
        return silver[name].select(*dict.fromkeys([*SILVER_KEYS.get(name, ()), *REPORT_READS[name]]))

    return LazyTables({name: partial(one, name) for name in silver})


def silver_rules() -> dict[str, list[checks.Rule]]:
    """Row rules a conformed table must meet to be stored."""
    # Allowed labels and monthly statuses.
    return {
        "application": [
            checks.not_null("SK_ID_CURR"),
            checks.in_set("TARGET", (0, 1)),
            checks.in_range("DAYS_BIRTH", high=0),
        ],
        "bureau_balance": [checks.in_set("STATUS", ("C", "X", "0", "1", "2", "3", "4", "5"))],
        "POS_CASH_balance": [checks.in_range("SK_DPD", low=0), checks.in_range("SK_DPD_DEF", low=0)],
        "credit_card_balance": [checks.in_range("SK_DPD", low=0)],
    }


def silver_links() -> tuple[checks.Link, ...]:
    """The references between conformed tables, where both samples are one table."""
    return tuple(
        checks.Link(link.child, link.key, ("application",) if len(link.parents) > 1 else link.parents)
        for link in LINKS
    )


def _finding(
    check: Column | str, table: str, detail: Column | str, df: DataFrame, count: Column | str
) -> DataFrame:
    return df.select(
        (F.lit(check) if isinstance(check, str) else check).alias("check_name"),
        F.lit(table).alias("table_name"),
        (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"),
        (F.col(count) if isinstance(count, str) else count).cast("bigint").alias("failed_count"),
    )


def _raw(bronze: Mapping[str, DataFrame], table: str) -> DataFrame:
    """The rows a conformed table is made of, with sentinels as NULL."""
    if table == "application":
        df = conform.unify_applications(bronze["application_train"], bronze["application_test"])
    else:
        df = bronze[table]
    sentinels = _present(df, dict.fromkeys(SENTINELS.get(table, ()), DAYS_SENTINEL))
    return conform.sentinel_to_null(df, sentinels, flag=False) if sentinels else df


def changes(bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> list[DataFrame]:
    """What conforming took away: values that did not fit their type (``rejected``), rows that were
    duplicates (``dropped``), and how many rows had no key of their own before (``unique``).

    Keys and offsets are read apart: their columns hardly overlap, so no value is read twice, and
    the grouping by key carries nothing but keys. Only installments, which may come from a join, are
    read once, and their grouping carries the counts of values that did not fit."""
    parts, column = [], F.substring("found", len("rejected_") + 1, 1000)
    for table, keys in {**SILVER_KEYS, "installments_payments": INSTALMENT_KEY}.items():
        raw = _raw(bronze, table)
        types, carried = offset_types(raw), []
        if table == "installments_payments":
            flags = [fails.cast("int").alias(f"rejected_{c}") for c, fails in conform.misfits(raw, types).items()]
            raw = raw.select(*keys, *flags)
            carried = [c for c in raw.columns if c not in keys]
        else:
            counts = conform.cast_rejects(raw, types)
            rejected = counts.unpivot([], counts.columns, "found", "n")
            parts.append(_finding("rejected", table, column, rejected, "n"))
        per_key = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in carried])
        complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        total = F.coalesce(F.sum("rows"), F.lit(0))
        kept = silver[table].agg(F.count(F.lit(1)).alias("kept")).scalar()
        found = per_key.agg(
            (total - kept).alias("dropped"), (total - F.count_if(complete)).alias("unique"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in carried],
        ).unpivot([], ["dropped", "unique", *carried], "found", "n")
        check = F.when(F.col("found").isin("dropped", "unique"), F.col("found")).otherwise("rejected")
        detail = F.when(F.col("found") == "dropped", "duplicates").when(F.col("found") == "unique", ",".join(keys))
        parts.append(_finding(check, table, detail.otherwise(column), found, "n"))
    return parts


def drifts(train: DataFrame, test: DataFrame, points: float = 5.0) -> list[DataFrame]:
    """Per category column, the values that one sample lacks; and the columns whose share of NULLs
    differs by at least ``points`` percent points."""
    profile = profiles()["application_train"]
    both = set(train.columns) & set(test.columns)
    categories = [c for c in profile.categories if c in both]
    nullable = [c for c in profile.nullable if c in both]
    seen = checks.category_drift(train, test, categories, unseen_only=False).groupBy("column_name")
    unseen = seen.agg(F.count_if((F.col("train_count") == 0) | (F.col("test_count") == 0)).alias("n"))
    shares = checks.profile_drift(train, test, nullable).agg(F.count_if(F.abs("delta") >= points).alias("n"))
    return [
        _finding("category_drift", "application", F.col("column_name"), unseen, "n"),
        _finding("null_rate_drift", "application", f"{points:g} points", shares, "n"),
    ]


def quality_parts(silver: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The findings of the quality report, by what is grouped for them."""
    routes = [checks.Route(table, "SK_ID_PREV", "previous_application", "SK_ID_CURR") for table in TWO_ROUTES]
    references = checks.reference_summary(silver, silver_links(), routes).withColumnRenamed("child", "table_name")
    return [references, *changes(bronze, silver), *drifts(bronze["application_train"], bronze["application_test"])]


def quality_report(silver: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Findings that do not stop the pipeline, as (check_name, table_name, detail, failed_count):
    orphans and disagreeing routes to the applicant in the conformed tables, what conforming took
    away from the raw ones, and drift between the two samples."""
    return reduce(DataFrame.unionAll, quality_parts(silver, bronze))


def staged_report(silver: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame]) -> DataFrame:
    """``quality_report`` from parts that are stored one after the other: each has a few rows, but
    the exchanges of all of them at once would be as large as the tables."""
    spark, found = next(iter(silver.values())).sparkSession, []
    folder = work_dir(spark)
    for number, part in enumerate(quality_parts(silver, bronze)):
        land(part, folder, f"part{number}")
        found.append(spark.read.schema(part.schema).parquet(f"{folder}/part{number}"))
    return reduce(DataFrame.unionAll, found)


# The conformed tables each dimension is made of.
DIMENSION_INPUTS = {
    "dim_bureau": ("bureau", "bureau_balance"),
    "dim_previous_application": ("previous_application",),
    "dim_installments_agg": ("installments_payments",),
    "dim_credit_card_agg": ("credit_card_balance",),
    "dim_pos_cash_agg": ("POS_CASH_balance",),
}


def gold_dimensions(silver: Mapping[str, DataFrame], reasons: Sequence[str] = ()) -> LazyTables:
    """All dimensions, one row per applicant."""
    return LazyTables(
        {
            "bureau": lambda: marts.dim_bureau(
                silver["bureau"], marts.status_by_credit(silver["bureau_balance"])
            ),
            "previous_application": lambda: marts.dim_previous_application(
                silver["previous_application"], reasons=reasons
            ),
            "installments_agg": lambda: marts.dim_installments_agg(silver["installments_payments"]),
            "credit_card_agg": lambda: marts.dim_credit_card_agg(silver["credit_card_balance"]),
            "pos_cash_agg": lambda: marts.dim_pos_cash_agg(silver["POS_CASH_balance"]),
        }
    )


def gold_tables(silver: Mapping[str, DataFrame], reasons: Sequence[str] = ()) -> LazyTables:
    """The star schema: ``dim_*`` and ``fact_application``."""
    dims = gold_dimensions(silver, reasons)
    builders = {f"dim_{name}": lambda name=name: dims[name] for name in dims}
    return LazyTables(
        {**builders, "fact_application": lambda: marts.fact_application(silver["application"], dims)}
    )


def run_pipeline(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    fmt: str = "parquet",
    reasons: Sequence[str] | None = None,
    buckets: int | None = None,
    at_a_time: int = 1,
    resume: bool = True,
) -> dict[str, int]:
    """Landing to star schema in one call; returns the rows written per table. All specs share
    one catalog and schema prefix.

    Each layer reads the stored tables of the one before, so a lost executor costs the work of
    one table at most. A lost driver costs the tables in work: the ledger ``gold.run_ledger`` says
    which tables a run has published from which files and parameters, and with ``resume`` the next
    call leaves those as they are. After a run that finished, all tables are replaced again.

    With ``buckets`` the applications and dimensions, which are unique on the applicant, are stored
    bucketed by it, and the fact joins them without an exchange; the fact has Bloom filters of its
    applicants too. ``reasons`` are the reject codes to count; by default all that occur, found in
    one pass.

    The shuffle files of a table go as soon as it is stored, so the disk holds the tables and the
    shuffles of those in work.
    """
    with shuffles_freed(spark):
        return _run_pipeline(spark, specs, fmt, reasons, buckets, at_a_time, resume)


def _run_pipeline(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    fmt: str,
    reasons: Sequence[str] | None,
    buckets: int | None,
    at_a_time: int,
    resume: bool,
) -> dict[str, int]:
    catalog, prefix = specs[0].catalog, specs[0].schema_prefix
    ensure_schemas(spark, catalog, prefix=prefix)
    ledger = RunLedger(spark, f"{catalog}.{prefix}gold.run_ledger", resume)
    per_applicant = (buckets, "SK_ID_CURR") if buckets else None
    rows: dict[str, int] = {}
    inputs = {f"bronze.{s.table}": fingerprint(files_fingerprint(spark, s.landing_path), fmt) for s in specs}

    known = {s.table: ledger.published(s.target_table, inputs[f"bronze.{s.table}"]) for s in specs}
    rows |= {f"bronze.{table}": n for table, n in known.items() if n is not None}
    left = [spec for spec in specs if known[spec.table] is None]
    written = ingest_all(
        spark, left, fmt, at_a_time, verify=True,
        done=lambda spec, n: ledger.record(spec.target_table, inputs[f"bronze.{spec.table}"], n),
    )
    rows |= {f"bronze.{table}": n for table, n in written.items()}
    bronze = LazyTables({spec.table: partial(spark.table, spec.target_table) for spec in specs})

    def store(
        job_type, layer: str, name: str, build: Callable[[], DataFrame], reads: Sequence[str], rules=(),
        bucketed: bool = False, staged=None, lookup: str | None = None,
    ) -> DataFrame:
        """The table, stored now unless this run has it. ``reads`` are the tables it is built from."""
        key, target = f"{layer}.{name}", f"{catalog}.{prefix}{layer}.{name}"
        dealt = per_applicant if bucketed else None
        inputs[key] = fingerprint(*(inputs[r] for r in reads), fmt, dealt, *(reasons or () if layer == "gold" else ()))
        rows[key] = ledger.published(target, inputs[key])
        if rows[key] is None:
            job = job_type(spark, target, build, rules, fmt, dealt, staged, lookup)
            job.run()
            rows[key] = job.rows_written
            ledger.record(target, inputs[key], rows[key])
        return spark.table(target)

    def store_all(job_type, layer: str, tables: Mapping[str, DataFrame], reads, rules, bucketed) -> dict[str, DataFrame]:
        """Store tables that do not depend on each other, ``at_a_time`` of them together."""

        def one(name: str) -> tuple[str, DataFrame]:
            build = partial(tables.__getitem__, name)
            return name, store(job_type, layer, name, build, reads(name), rules.get(name, ()), name in bucketed)

        with ThreadPoolExecutor(max_workers=at_a_time) as pool:
            return dict(pool.map(one, tables))

    def raw_of(name: str) -> list[str]:
        return ["bronze.application_train", "bronze.application_test"] if name == "application" else [f"bronze.{name}"]

    silver = store_all(
        SilverJob, "silver", silver_tables(bronze, rare_duplicates=True), raw_of, silver_rules(), {"application"}
    )
    if reasons is None:
        reasons = marts.reason_codes(silver["previous_application"])
    dims = gold_dimensions(silver, reasons)
    named = LazyTables({f"dim_{name}": partial(dims.get, name) for name in dims})
    every = [f"silver.{name}" for name in silver]
    stored = store_all(GoldJob, "gold", named, lambda name: [f"silver.{t}" for t in DIMENSION_INPUTS[name]], {}, set(named))
    store(SilverJob, "silver", "quality_report", lambda: staged_report(silver, bronze), [*every, *_names("bronze", specs)])

    def fact() -> DataFrame:
        return marts.fact_application(silver["application"], {n: stored[f"dim_{n}"] for n in dims})

    def no_fan_out(staged: DataFrame) -> None:
        preserved = checks.row_preservation(staged, silver["application"], "SK_ID_CURR").first()
        if not preserved["is_preserved"]:
            raise checks.CheckFailed(f"the fact does not have the rows of the applications: {preserved.asDict()}")

    store(
        GoldJob, "gold", "fact_application", fact, ["silver.application", *(f"gold.{name}" for name in named)],
        bucketed=True, staged=no_fan_out, lookup="SK_ID_CURR",
    )
    ledger.finish()
    return rows


def _names(layer: str, specs: Sequence[TableSpec]) -> list[str]:
    return [f"{layer}.{spec.table}" for spec in specs]
