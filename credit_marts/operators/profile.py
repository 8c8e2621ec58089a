"""Profiling of one table: keys, missing values, ranges, classes, categories, references, delays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_marts.functions import half_up_percent, is_late, payment_delay


def _ones(condition: Column) -> Column:
    """Count of rows meeting a condition, NULL over no rows (a sum, not a count)."""
    return F.sum(F.when(condition, 1).otherwise(0))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def key_profile(df: DataFrame, keys: Sequence[str], lead: str | None = None) -> DataFrame:
    """Rows, distinct keys and surplus rows of a natural key.

    A row with a NULL key part is not distinct, so it counts as a duplicate. A key of several
    columns also reports the distinct values of its ``lead`` column (the first one by default).

    The composite form first reduces the table to one row per key and then counts both levels.
    Two distinct counts in one aggregate would make Spark triple every input row instead.
    """
    if len(keys) == 1:
        name = keys[0].lower()
        distinct = F.count_distinct(keys[0])
        return df.agg(
            F.count(F.lit(1)).alias("row_count"),
            distinct.alias(f"distinct_{name}"),
            (F.count(F.lit(1)) - distinct).alias(f"duplicate_{name}"),
        )
    lead = lead or keys[0]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    complete = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    rows = F.coalesce(F.sum("_rows"), F.lit(0))
    distinct = F.count_if(complete)
    return per_key.agg(
        rows.alias("row_count"),
        F.count_distinct(lead).alias(f"distinct_{lead.lower()}"),
        distinct.alias("distinct_key_combo"),
        (rows - distinct).alias("duplicate_key_combo"),
    )


def key_profiles(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Rows, distinct keys and surplus rows of several natural keys, as (key_columns, row_count,
    distinct_count, duplicate_count), with one scan and one exchange for all of them.

    The keys are grouping sets of one aggregate: a row goes out once per set, tagged with it, and is
    combined with its like inside the task, so what is exchanged is one row per key and task, as for
    every key alone. A key with a NULL part is not distinct.
    """
    columns = list(dict.fromkeys(c for keys in key_sets for c in keys))
    last = len(columns) - 1
    tags = {sum(1 << (last - i) for i, c in enumerate(columns) if c not in keys): keys for keys in key_sets}
    groups = df.groupingSets([list(keys) for keys in tags.values()], *columns).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows")
    )
    complete = reduce(
        lambda rest, own: F.when(
            F.col("_set") == own[0], reduce(Column.__and__, [F.col(c).isNotNull() for c in own[1]])
        ).otherwise(rest),
        tags.items(),
        F.lit(False),
    )
    found = groups.groupBy("_set").agg(F.sum("_rows").alias("rows"), F.count_if(complete).alias("keys"))
    named = df.sparkSession.createDataFrame(
        [(tag, ",".join(keys)) for tag, keys in tags.items()], "_set bigint, key_columns string"
    )
    rows, distinct = F.coalesce("rows", F.lit(0)), F.coalesce("keys", F.lit(0))
    return named.join(found, "_set", "left").select(
        "key_columns", rows.alias("row_count"), distinct.alias("distinct_count"), (rows - distinct).alias("duplicate_count")
    )


def null_rate_aggregates(columns: Sequence[str]) -> list[Column]:
    """Share of NULLs per column in percent; NULL over no rows."""
    total = F.count(F.lit(1))
    return [
        half_up_percent(_ones(F.col(c).isNull()), total).alias(f"pct_null_{c.lower()}")
        for c in columns
    ]


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and percentage of NULLs of each column, in one scan."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *null_rate_aggregates(columns))


@dataclass(frozen=True)
class Measure:
    """What to report of one numeric column or expression.

    ``stats`` are any of min, max and avg. With a ``sentinel`` (a number that stands for "no
    value") its rows are counted and the statistics leave them out.
    """

    alias: str
    value: Column | str
    stats: tuple[str, ...] = ("min", "max", "avg")
    sentinel: int | None = None

    def aggregates(self) -> list[Column]:
        value = F.col(self.value) if isinstance(self.value, str) else self.value
        functions = {"min": F.min, "max": F.max, "avg": F.avg}
        if self.sentinel is None:
            return [functions[s](value).alias(f"{s}_{self.alias}") for s in self.stats]
        real = F.when(value != self.sentinel, value)
        return [_ones(value == self.sentinel).alias(f"{self.alias}_sentinel_count")] + [
            functions[s](real).alias(f"{s}_{self.alias}_excl_sentinel") for s in self.stats
        ]


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, so that results have the same type whatever the literals were."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("double").alias(name) if kind.startswith("decimal") else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def range_stats(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Bounds and averages of several measures, in one scan. NULLs are skipped."""
    return decimals_to_double(df.agg(*[a for m in measures for a in m.aggregates()]))


def class_balance(df: DataFrame, column: str) -> DataFrame:
    """Rows per class and their share of all rows. NULL is a class of its own and comes first.

    The total is a scalar subquery over the already counted classes. Spark reuses their
    exchange for it, and no step gathers all classes in one task as a window over the whole
    result would.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    share = half_up_percent(F.col("row_count"), total)
    return counts.select(column, "row_count", share.alias("pct_of_total")).orderBy(column)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of one column, ordered by value; NULL is a value and comes first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(column)


def category_counts(
    df: DataFrame, columns: Sequence[str], one_pass: bool = False, ordered: bool = True
) -> DataFrame:
    """Rows per value of several columns in long form (column_name, value as text, row_count).

    By default one group-by per column: over a columnar table each branch reads its own column
    only, so no byte is read twice, and no row has to be multiplied. ``one_pass`` unpivots
    instead; use it when ``df`` is the result of joins that should not run once per column.
    """
    if one_pass:
        text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        long = text.unpivot([], list(columns), "column_name", "value")
        counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    else:
        counts = reduce(
            DataFrame.unionAll,
            [
                df.groupBy(F.col(c).alias("value"))
                .agg(F.count(F.lit(1)).alias("row_count"))
                .select(F.lit(c).alias("column_name"), F.col("value").cast("string").alias("value"), "row_count")
                for c in columns
            ],
        )
    return counts.orderBy("column_name", "value") if ordered else counts


@dataclass(frozen=True)
class Parent:
    """A referenced table and its key column."""

    df: DataFrame
    key: str

    def keys(self, name: str) -> DataFrame:
        return self.df.select(F.col(self.key).alias(name))


def orphan_keys(child: DataFrame, key: str, parents: Sequence[Parent]) -> DataFrame:
    """Keys of ``child`` found in none of the parents, with the number of rows that carry them.

    The child is reduced to one row per key before any join, so a key held by a third of all
    rows costs one row, and the joins keep the partitioning of that reduction.
    """
    left = child.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    for parent in parents:
        left = left.join(parent.keys(key), key, "left_anti")
    return left


def orphan_count(child: DataFrame, key: str, parents: Sequence[Parent]) -> DataFrame:
    """Rows whose key is in none of the parents. A NULL key refers to nothing and counts too."""
    total = F.coalesce(F.sum("row_count"), F.lit(0))
    return orphan_keys(child, key, parents).agg(total.alias(f"orphan_{key.lower()}_count"))


def orphan_counts(child: DataFrame, references: Mapping[str, Sequence[Parent]]) -> DataFrame:
    """``orphan_count`` of several keys of one table, side by side in one row."""
    counts = [orphan_count(child, key, parents) for key, parents in references.items()]
    return child.sparkSession.range(1).select(*[c.scalar().alias(c.columns[0]) for c in counts])


def orphans(child: DataFrame, key: str, parents: Sequence[Parent]) -> DataFrame:
    """The rows whose key is in none of the parents, including those with a NULL key.

    NULL keys need no join and are taken straight from the table, so they never meet in one
    partition. All parents are checked by a single join, the last step of the plan, where
    adaptive execution can split a partition with a hot key.
    """
    name = "_parent_key"
    known = reduce(DataFrame.unionAll, [p.keys(name) for p in parents])
    keyed = child.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col(name), "left_anti")
    return child.where(F.col(key).isNull()).unionAll(keyed)


def _bloom_bits(value: Column) -> list[Column]:
    """One bit of each of a block's words, by eight independent hashes of a value."""
    places = [F.pmod(F.xxhash64(value, F.lit(i)), F.lit(64)).cast("int") for i in range(8)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]


def _bloom_block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit("block")), F.lit(blocks))


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """A Bloom filter of a key column as rows (block, w0..w7) of 512 bits each, ``blocks`` at most.

    Tasks fold their keys to one row per block before the exchange, so what is exchanged does not
    grow with the keys; filters of parts of a table merge by the same bitwise OR.
    """
    bits = [b.alias(f"w{i}") for i, b in enumerate(_bloom_bits(F.col(key)))]
    rows = keys.where(F.col(key).isNotNull()).select(_bloom_block(F.col(key), blocks).alias("block"), *bits)
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def orphans_by_bloom(
    child: DataFrame, key: str, parents: Sequence[Parent], blocks: int = 1 << 15
) -> DataFrame:
    """``orphans`` for parents that are too large to broadcast and references that are mostly broken.

    The parents' keys are folded to a Bloom filter of at most ``blocks`` rows of 72 bytes, which goes
    to all tasks whatever the parents' size. A key it lacks is an orphan for certain and meets no
    exchange; a key it may have goes through the exact anti join. About 30 keys a block leave one
    orphan in a thousand to the join; more keys leave more of them, and change no result.
    """
    name = "_parent_key"
    known = reduce(DataFrame.unionAll, [p.keys(name) for p in parents])
    words = [f"w{i}" for i in range(8)]
    filters = bloom_blocks(known, name, blocks).select("block", F.struct(*words).alias("_words"))
    block = _bloom_block(F.col(key), blocks)
    marked = child.withColumn("_block", block).join(
        F.broadcast(filters.withColumnRenamed("block", "_block")), "_block", "left"  # ``blocks`` rows at most
    )
    has = reduce(
        Column.__and__,
        [F.col(f"_words.w{i}").bitwiseAND(b) != 0 for i, b in enumerate(_bloom_bits(F.col(key)))],
    )
    may = F.col(key).isNotNull() & F.coalesce(has, F.lit(False))
    columns = [F.col(f"`{c}`") for c in child.columns]
    sure = marked.where(~may).select(*columns)
    rest = marked.where(may).select(*columns).join(known, F.col(key) == F.col(name), "left_anti")
    return sure.unionAll(rest)


def missing_event_aggregates(amount: str, day: str) -> list[Column]:
    missed = _ones(F.col(amount).isNull())
    return [
        missed.alias("missed_payment_count"),
        half_up_percent(missed, F.count(F.lit(1))).alias("pct_missed_payment"),
        _ones(F.col(day).isNull()).alias(f"null_{day.lower()}_count"),
    ]


def missing_event_profile(df: DataFrame, amount: str, day: str) -> DataFrame:
    """Events that did not happen: rows without an amount, and rows without a day."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *missing_event_aggregates(amount, day))


def delay_aggregates(
    due: str, paid_on: str, number: str, number_alias: str = "instalment_number"
) -> list[Column]:
    """Installment numbers, delays and late rows among the events that did happen; without one, NULL."""
    delay, happened = payment_delay(F.col(due), F.col(paid_on)), F.col(paid_on).isNotNull()
    late = F.when(is_late(F.col(due), F.col(paid_on)), 1).otherwise(0)
    return [
        F.min(F.when(happened, F.col(number))).alias(f"min_{number_alias}"),
        F.max(F.when(happened, F.col(number))).alias(f"max_{number_alias}"),
        F.min(delay).alias("min_payment_delay_days"),
        F.max(delay).alias("max_payment_delay_days"),
        F.avg(delay).alias("avg_payment_delay_days"),
        F.sum(F.when(happened, late)).alias("late_payment_count"),
    ]


def delay_profile(
    df: DataFrame, due: str, paid_on: str, number: str, number_alias: str = "instalment_number"
) -> DataFrame:
    """Installment numbers, delays and late rows among the events that did happen."""
    happened = df.where(F.col(paid_on).isNotNull())
    return decimals_to_double(happened.agg(*delay_aggregates(due, paid_on, number, number_alias)))


def long_form(one_row: DataFrame) -> DataFrame:
    """A one-row result as (metric, value) rows, values as DOUBLE."""
    values = one_row.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in one_row.columns])
    return values.unpivot([], values.columns, "metric", "value")


def profile_table(
    df: DataFrame,
    null_columns: Sequence[str] = (),
    measures: Sequence[Measure] = (),
    missing_event: Mapping[str, str] | None = None,
    delay: Sequence[str] | None = None,
) -> DataFrame:
    """Row count, NULL rates, ranges, missing events and delays of a table as (metric, value), in one scan."""
    aggregates = [F.count(F.lit(1)).alias("total_rows"), *null_rate_aggregates(null_columns)]
    aggregates += [a for m in measures for a in m.aggregates()]
    if missing_event:
        aggregates += missing_event_aggregates(**missing_event)
    if delay:
        aggregates += delay_aggregates(*delay)
    return long_form(df.agg(*aggregates))
