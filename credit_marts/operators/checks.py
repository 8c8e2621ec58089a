"""Quality checks: expectations, uniqueness, references, drift, preservation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_marts.operators.profile import (
    Measure,
    Parent,
    key_profile,
    long_form,
    null_rate_aggregates,
    orphan_keys,
)


class CheckFailed(ValueError):
    """Data that does not meet its checks."""


@dataclass(frozen=True)
class Rule:
    """A named condition that marks a row as failing. NULL does not fail, as in a CHECK constraint."""

    name: str
    fails: Column


def not_null(column: str) -> Rule:
    return Rule(f"not_null({column})", F.col(column).isNull())


def in_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    """Bounds are inclusive; None leaves a side open."""
    fails = F.lit(False)
    if low is not None:
        fails = fails | (F.col(column) < low)
    if high is not None:
        fails = fails | (F.col(column) > high)
    bounds = "..".join("" if b is None else str(b) for b in (low, high))
    return Rule(f"in_range({column}, {bounds})", fails)


def in_set(column: str, values: Sequence[object]) -> Rule:
    return Rule(f"in_set({column})", ~F.col(column).isin(*values))


def rule_counts(rules: Sequence[Rule]) -> dict[str, Column]:
    """The number of failing rows of every rule as an aggregate, named by the rule's position:
    two rules may have one name."""
    return {f"rule{i}": F.count_if(rule.fails) for i, rule in enumerate(rules)}


def expectations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failing rows per rule as (rule, failed_count, total_rows). All rules share one scan."""
    counts = rule_counts(rules)
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), *[c.alias(n) for n, c in counts.items()])
    long = counted.unpivot(["total_rows"], list(counts), "place", "failed_count")
    names = F.create_map(*[F.lit(x) for n, rule in zip(counts, rules, strict=True) for x in (n, rule.name)])
    return long.select(names[F.col("place")].alias("rule"), "failed_count", "total_rows")


def raise_broken(rules: Sequence[Rule], counts: Mapping[str, int]) -> None:
    """Raise when a count of ``rule_counts`` says that a rule does not hold."""
    broken = [f"{rule.name}: {n} rows" for rule, n in zip(rules, map(counts.get, rule_counts(rules)), strict=True) if n]
    if broken:
        raise CheckFailed(", ".join(broken))


def enforce(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise when any row breaks a rule."""
    if rules:
        raise_broken(rules, df.agg(*[c.alias(n) for n, c in rule_counts(rules).items()]).first().asDict())


def _raise_on(failures: DataFrame, name: str, count: str) -> None:
    broken = failures.collect()
    if broken:
        raise CheckFailed(", ".join(f"{r[name]}: {r[count]} rows" for r in broken))


def unique_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``key_profile`` with ``is_unique``. For events whose key may repeat this is a report only."""
    profile = key_profile(df, keys)
    duplicates = [c for c in profile.columns if c.startswith("duplicate_")][0]
    return profile.withColumn("is_unique", F.col(duplicates) == 0)


def enforce_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats or is NULL."""
    row = unique_check(df, keys).first()
    if not row["is_unique"]:
        raise CheckFailed(f"key ({', '.join(keys)}) is not unique: {row.asDict()}")


@dataclass(frozen=True)
class Link:
    """A child column that must be found in the given key column of at least one parent."""

    child: str
    key: str
    parents: tuple[str, ...]
    parent_key: str | None = None


def fk_report(tables: Mapping[str, DataFrame], links: Sequence[Link]) -> DataFrame:
    """Orphan rows and orphan keys of every link, as (child, key, parents, orphan_count, orphan_keys)."""

    def one(link: Link) -> DataFrame:
        parents = [Parent(tables[p], link.parent_key or link.key) for p in link.parents]
        left = orphan_keys(tables[link.child], link.key, parents)
        return left.agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_count"),
            F.count(link.key).alias("orphan_keys"),
        ).select(
            F.lit(link.child).alias("child"),
            F.lit(link.key).alias("key"),
            F.lit(",".join(link.parents)).alias("parents"),
            "orphan_count",
            "orphan_keys",
        )

    return reduce(DataFrame.unionAll, [one(link) for link in links])


def enforce_fk(tables: Mapping[str, DataFrame], links: Sequence[Link]) -> None:
    """Raise when a link has orphans."""
    report = fk_report(tables, links).where("orphan_count > 0")
    _raise_on(report.withColumn("link", F.concat_ws(".", "child", "key")), "link", "orphan_count")


def path_agreement(
    child: DataFrame, bridge: DataFrame, key: str, owner: str, bridge_key: str | None = None
) -> DataFrame:
    """Whether ``owner`` in the child equals the ``owner`` of the bridge row it refers to.

    Rows without a bridge row are not compared (they are orphans). The child is first reduced
    to its distinct (key, owner) pairs, so repeated rows of a hot key do not reach the join.
    """
    pairs = child.where(F.col(key).isNotNull()).groupBy(key, owner).agg(F.count(F.lit(1)).alias("_rows"))
    via = bridge.select(F.col(bridge_key or key).alias(key), F.col(owner).alias("_via"))
    differs = ~F.col(owner).eqNullSafe(F.col("_via"))
    return pairs.join(via, key).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("compared_count"),
        F.coalesce(F.sum(F.when(differs, F.col("_rows")).otherwise(0)), F.lit(0)).alias("disagreement_count"),
    )


@dataclass(frozen=True)
class Route:
    """An owner that the rows of ``child`` name themselves and reach through ``bridge`` by ``key``."""

    child: str
    key: str
    bridge: str
    owner: str


def reference_summary(
    tables: Mapping[str, DataFrame], links: Sequence[Link], routes: Sequence[Route] = ()
) -> DataFrame:
    """What ``fk_report`` and ``path_agreement`` find, with one scan and one grouping of every child,
    as (check_name, child, detail, failed_count).

    A child is reduced to its distinct combinations of keys with their row counts. Each reference
    looks its key up in turn and then folds that key away: the counts found so far go along as
    sums, so the next reference meets fewer rows, and in the end one row is left. A hot key is one
    row per combination before the first join and one row before the last; incomplete keys spread
    over all tasks and match nothing.
    """
    children = dict.fromkeys(link.child for link in links)
    parts = []
    for child in children:
        own = [link for link in links if link.child == child]
        parts.append(_summary_of(tables, child, own, [route for route in routes if route.child == child]))
    return reduce(DataFrame.unionAll, parts)


def _known_keys(tables: Mapping[str, DataFrame], link: Link, bridges: Sequence[Route]) -> DataFrame:
    """The keys a link may refer to, once each, and the owners that its routes compare. A bridge must
    be unique on its key."""
    key = link.parent_key or link.key
    if bridges:
        owners = dict.fromkeys(route.owner for route in bridges)
        known = tables[bridges[0].bridge].select(
            F.col(key).alias(link.key), *[F.col(o).alias(f"_via_{o}") for o in owners]
        ).where(F.col(link.key).isNotNull())
    else:
        parents = [tables[p].select(F.col(key).alias(link.key)) for p in link.parents]
        known = reduce(DataFrame.unionAll, parents).where(F.col(link.key).isNotNull()).distinct()
    return known.withColumns({"_known": F.lit(True), "_spread": F.lit(0).cast("bigint")})


def _summary_of(
    tables: Mapping[str, DataFrame], child: str, links: Sequence[Link], routes: Sequence[Route]
) -> DataFrame:
    # Keys that a route starts from come first: what a later reference looks up stays in the rows.
    links = sorted(links, key=lambda link: not any(route.key == link.key for route in routes))
    keys = list(dict.fromkeys([*(link.key for link in links), *(c for r in routes for c in (r.key, r.owner))]))
    rows = tables[child].groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    found: list[tuple[str, str, str]] = []  # check, detail, name of its sum
    for n, link in enumerate(links):
        name, bridges = f"_found_{n}", [route for route in routes if route.key == link.key]
        # NULL keys get a number that no parent has, so that they do not meet in one task.
        spread = F.when(F.col(link.key).isNull(), 1 + F.pmod(F.xxhash64(*keys), F.lit(1 << 20))).otherwise(0)
        rows = rows.withColumn("_spread", spread).join(_known_keys(tables, link, bridges), [link.key, "_spread"], "left")
        sums = {name: F.when(F.col("_known").isNull(), F.col("_rows")).otherwise(0)}
        found.append(("reference", f"{link.key} -> {','.join(link.parents)}", name))
        for route in bridges:
            differs = F.col("_known").isNotNull() & ~F.col(route.owner).eqNullSafe(F.col(f"_via_{route.owner}"))
            sums[f"_route_{route.owner}"] = F.when(differs, F.col("_rows")).otherwise(0)
            found.append(("route", route.owner, f"_route_{route.owner}"))
        before = [s for _, _, s in found if s not in sums]
        keys = [k for k in keys if k in {l.key for l in links[n + 1 :]}]
        totals = [F.sum(c).alias(a) for a, c in {"_rows": F.col("_rows"), **{b: F.col(b) for b in before}, **sums}.items()]
        rows = rows.groupBy(*keys).agg(*totals)
    listed = F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(detail).alias("detail"), F.coalesce(F.col(name), F.lit(0)).alias("n"))
        for check, detail, name in found
    ])
    return rows.select(F.explode(listed).alias("_one")).select(
        "_one.check_name", F.lit(child).alias("child"), "_one.detail", F.col("_one.n").cast("bigint").alias("failed_count")
    )


def category_drift(
    train: DataFrame, test: DataFrame, columns: Sequence[str], unseen_only: bool = True
) -> DataFrame:
    """Values of categorical columns with their rows on each side, by default only the values
    that one side lacks. Both sides are counted together, in one pass over each."""
    sides = [
        df.select(F.lit(flag).alias("_train"), *[F.col(c).cast("string").alias(c) for c in columns])
        for df, flag in ((train, 1), (test, 0))
    ]
    both = (
        sides[0]
        .unionAll(sides[1])
        .unpivot(["_train"], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.sum("_train").alias("train_count"), F.sum(1 - F.col("_train")).alias("test_count"))
    )
    return both.where("train_count = 0 OR test_count = 0") if unseen_only else both


def profile_drift(
    train: DataFrame, test: DataFrame, null_columns: Sequence[str] = (), measures: Sequence[Measure] = ()
) -> DataFrame:
    """NULL rates and ranges of both sides with their difference (test minus train)."""
    aggregates = null_rate_aggregates(null_columns) + [a for m in measures for a in m.aggregates()]
    sides = [
        long_form(df.agg(*aggregates)).withColumn("is_test", F.lit(flag))
        for df, flag in ((train, False), (test, True))
    ]
    return (
        sides[0]
        .unionAll(sides[1])
        .groupBy("metric")
        .agg(
            F.max(F.when(~F.col("is_test"), F.col("value"))).alias("train_value"),
            F.max(F.when(F.col("is_test"), F.col("value"))).alias("test_value"),
        )
        .withColumn("delta", F.col("test_value") - F.col("train_value"))
    )


def row_preservation(fact: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Whether joining dimensions left the rows of ``base`` as they were: no fan-out, no loss."""
    counts = [F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys")]
    sides = fact.agg(*counts).withColumn("is_fact", F.lit(True)).unionAll(
        base.agg(*counts).withColumn("is_fact", F.lit(False))
    )
    of_fact, of_base = F.col("is_fact"), ~F.col("is_fact")
    return sides.agg(
        F.max(F.when(of_base, F.col("rows"))).alias("base_rows"),
        F.max(F.when(of_fact, F.col("rows"))).alias("fact_rows"),
        F.max(F.when(of_base, F.col("keys"))).alias("base_keys"),
        F.max(F.when(of_fact, F.col("keys"))).alias("fact_keys"),
    ).withColumn(
        "is_preserved", (F.col("base_rows") == F.col("fact_rows")) & (F.col("base_keys") == F.col("fact_keys"))
    )


def reconcile_counts(source: DataFrame | int, target: DataFrame) -> DataFrame:
    """Rows of the source (a DataFrame, or the number a write reported) against those of the target."""
    counted = target.agg(F.count(F.lit(1)).alias("target_rows"))
    if isinstance(source, int):
        both = counted.select(F.lit(source).cast("bigint").alias("source_rows"), "target_rows")
    else:
        none = F.lit(None).cast("bigint")
        both = (
            source.agg(F.count(F.lit(1)).alias("source_rows"))
            .select("source_rows", none.alias("target_rows"))
            .unionAll(counted.select(none.alias("source_rows"), "target_rows"))
            .agg(F.max("source_rows").alias("source_rows"), F.max("target_rows").alias("target_rows"))
        )
    return both.withColumn("is_equal", F.col("source_rows") == F.col("target_rows"))
