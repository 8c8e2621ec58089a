"""Conforming of a table: types, sentinels, missing values, duplicates, derived columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from credit_marts.functions import (
    age_years,
    grant_gap,
    half_up_percent,
    is_delinquent,
    is_late,
    is_missed,
    payment_delay,
    ratio,
    safe_cast,
    status_severity,
)
from credit_marts.sources import land, work_dir


def _typed(df: DataFrame, column: str, target: str) -> Column:
    return safe_cast(F.col(column), df.schema[column].dataType, target)


def standardize_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The given columns in the given types; values that do not fit become NULL."""
    return df.withColumns({c: _typed(df, c, t) for c, t in types.items()})


def misfits(df: DataFrame, types: Mapping[str, str]) -> dict[str, Column]:
    """Per column, whether ``standardize_types`` turns its value into NULL."""
    return {c: F.col(c).isNotNull() & _typed(df, c, t).isNull() for c, t in types.items()}


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """How many values of each column ``standardize_types`` turns into NULL, in one scan."""
    return df.agg(*[F.count_if(fails).alias(f"rejected_{c}") for c, fails in misfits(df, types).items()])


def sentinel_to_null(
    df: DataFrame, sentinels: Mapping[str, int | float | str], flag: bool = True
) -> DataFrame:
    """NULL instead of a value that stands for "no value"; ``<column>_was_sentinel`` keeps the fact."""
    changed = {c: F.when(F.col(c) != v, F.col(c)) for c, v in sentinels.items()}
    if flag:
        changed |= {
            f"{c}_was_sentinel": F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
            for c, v in sentinels.items()
        }
    return df.withColumns(changed)


def null_policy(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """What a NULL means, per column: ``zero`` (nothing happened), ``keep`` (an event that is
    missing and must stay countable) or ``flag`` (kept, with ``<column>_is_null`` as a signal)."""
    changed = {}
    for column, rule in policy.items():
        if rule == "zero":
            changed[column] = F.coalesce(F.col(column), F.lit(0).cast(df.schema[column].dataType))
        elif rule == "flag":
            changed[f"{column}_is_null"] = F.col(column).isNull().cast("int")
        elif rule != "keep":
            raise ValueError(f"{column}: unknown rule {rule!r}")
    return df.withColumns(changed) if changed else df


def _complete(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def dedup(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), read: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the first in ``order``; the remaining columns break ties, values before
    NULL, so the choice is the same on every run.

    With ``read`` the caller promises to use no columns but these and the keys. Ties that are left
    after the last of them are between rows that are equal for the caller, so the columns behind it
    break none, and those that nobody reads are neither sorted nor exchanged.

    The rank filter lets Spark keep one row per key and task before the exchange, so a hot key
    sends one row per task. A row with a NULL key part identifies nothing: each is a group of its
    own, by a number that spreads them, and all of them are kept. The table is scanned once.
    """
    apart = F.when(~_complete(keys), F.monotonically_increasing_id())
    others = [c for c in df.columns if c not in keys]
    if read is not None:
        others = others[: max((n for n, c in enumerate(others, 1) if c in read), default=0)]
    tie_breakers = [F.col(c).asc_nulls_last() for c in others]
    window = Window.partitionBy(*keys, "_apart").orderBy(*(list(order) + tie_breakers or keys))
    ranked = df.withColumn("_apart", apart).withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_apart", "_rank")


# Repeated keys up to which they are looked up in the table: as many as Spark broadcasts by default.
MOST_REPEATED = 500_000


def _resolve_repeated(
    df: DataFrame, keys: Sequence[str], resolve: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``resolve`` applied to the rows whose key repeats, the other rows left where they are.

    A first job counts the keys alone and stores the repeated ones in the shared work folder, so
    that Spark knows their size when it chooses how to join them. Without any the table is
    returned as it is. With more than MOST_REPEATED of them both lookups would exchange the table,
    so ``resolve`` gets it as a whole and exchanges it once. A row with a NULL key part is never a
    repeated one.
    """
    counted = df.where(_complete(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    folder = work_dir(df.sparkSession)
    found = land(counted.where("_rows > 1").select(*keys), folder, "repeated_keys")
    if found == 0:
        return df
    if found > MOST_REPEATED:
        return resolve(df)
    repeated = df.sparkSession.read.parquet(f"{folder}/repeated_keys")
    single = df.join(repeated, list(keys), "left_anti").select(*df.columns)
    several = df.join(repeated, list(keys), "left_semi").select(*df.columns)
    return single.unionAll(resolve(several))


def dedup_rare(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), read: Sequence[str] | None = None
) -> DataFrame:
    """``dedup`` for a wide table in which few keys repeat: where their keys are small enough to be
    sent to the rows, only rows with a repeated key are exchanged. Runs a job on the keys."""
    return _resolve_repeated(df, keys, lambda rows: dedup(rows, keys, order, read))


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """Rows that are equal in every column kept once. For events whose key may repeat."""
    return df.distinct()


def drop_full_duplicates_rare(df: DataFrame) -> DataFrame:
    """``drop_full_duplicates`` for a wide table with few of them: one hash per row is exchanged,
    and only rows with a repeated hash, equal or not, are compared in full. Runs a job on the hashes."""
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    return _resolve_repeated(hashed, ["_hash"], DataFrame.distinct).drop("_hash")


def unify_applications(
    train: DataFrame, test: DataFrame, target: str = "TARGET", flag: str = "is_train"
) -> DataFrame:
    """Both samples as one table; the one without ``target`` gets NULL there."""
    tagged = train.withColumn(flag, F.lit(1)), test.withColumn(flag, F.lit(0))
    unified = tagged[0].unionByName(tagged[1], allowMissingColumns=True)
    return unified if target in unified.columns else unified.withColumn(target, F.lit(None).cast("bigint"))


def add_ratio(df: DataFrame, numerator: str, denominator: str, alias: str) -> DataFrame:
    """``numerator / denominator``, NULL at a zero denominator."""
    return df.withColumn(alias, ratio(F.col(numerator), F.col(denominator)))


def add_age(df: DataFrame, days_birth: str = "DAYS_BIRTH", alias: str = "age_years") -> DataFrame:
    """Age in years from a negative day offset."""
    return df.withColumn(alias, age_years(F.col(days_birth)).cast("double"))


def add_grant_gap(
    df: DataFrame, applied: str = "AMT_APPLICATION", granted: str = "AMT_CREDIT", alias: str = "grant_gap"
) -> DataFrame:
    """Amount asked for minus amount granted."""
    return df.withColumn(alias, grant_gap(F.col(applied), F.col(granted)))


def add_payment_delay(
    df: DataFrame,
    due: str = "DAYS_INSTALMENT",
    paid_on: str = "DAYS_ENTRY_PAYMENT",
    payment: str = "AMT_PAYMENT",
) -> DataFrame:
    """``payment_delay`` with 0/1 columns ``is_late`` and ``is_missed``."""
    return df.withColumns(
        {
            "payment_delay": payment_delay(F.col(due), F.col(paid_on)),
            "is_late": is_late(F.col(due), F.col(paid_on)).cast("int"),
            "is_missed": is_missed(F.col(payment)).cast("int"),
        }
    )


def add_status_severity(df: DataFrame, status: str = "STATUS", **codes: tuple[str, ...]) -> DataFrame:
    """``status_severity`` (NULL when unknown) and the 0/1 column ``is_delinquent``."""
    return df.withColumns(
        {
            "status_severity": status_severity(F.col(status), **codes),
            "is_delinquent": is_delinquent(F.col(status), **codes),
        }
    )


def block_columns(df: DataFrame, pattern: str = r"\w+_(AVG|MODE|MEDI)") -> list[str]:
    """Numeric columns whose whole name matches ``pattern``."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and re.fullmatch(pattern, f.name)
    ]


def building_block(df: DataFrame, columns: Iterable[str], alias: str = "building") -> DataFrame:
    """A block of columns as one: the mean of the values present and how many there are."""
    columns = list(columns)
    present = reduce(Column.__add__, [F.col(c).isNotNull().cast("int") for c in columns])
    total = reduce(Column.__add__, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return df.withColumns({f"{alias}_mean": F.try_divide(total, present), f"{alias}_present": present})


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column as (column_name, null_count, total_rows, pct_null), in one scan."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    share = half_up_percent(F.col("null_count"), F.col("total_rows"))
    return counted.unpivot(["total_rows"], columns, "column_name", "null_count").withColumn("pct_null", share)


def mostly_null_columns(
    df: DataFrame, threshold: float, columns: Sequence[str] | None = None
) -> list[str]:
    """Columns with at least ``threshold`` percent NULLs. Runs one aggregation."""
    report = null_report(df, columns).where(F.col("pct_null") >= threshold)
    return [r["column_name"] for r in report.select("column_name").collect()]


def drop_mostly_null(df: DataFrame, threshold: float, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` without its nearly empty columns; ``null_report`` tells which those are."""
    return df.drop(*mostly_null_columns(df, threshold, columns))
