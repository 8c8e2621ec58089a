"""Small pieces of DuckDB SQL used by the counterparts."""

from __future__ import annotations

from collections.abc import Sequence


def percent(part: str, whole: str) -> str:
    """Percentage with two decimals, rounded half up in whole numbers; NULL when ``whole`` is 0."""
    return (
        f"CAST(CASE WHEN {whole} > 0 THEN (20000 * {part} + {whole}) // (2 * {whole}) END AS DOUBLE) / 100"
    )


def ones(condition: str) -> str:
    """Rows meeting a condition; NULL over no rows."""
    return f"CAST(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {condition}) END AS BIGINT)"


def null_rates(table: str, columns: Sequence[str]) -> str:
    rates = [
        f"{percent(f'(count(*) - count({c}))', 'count(*)')} AS pct_null_{c.lower()}" for c in columns
    ]
    return f"SELECT count(*) AS total_rows, {', '.join(rates)} FROM {table}"


def key_profile(table: str, keys: Sequence[str]) -> str:
    """Counts rows per key first; a key with a NULL part is not a key."""
    listed = ", ".join(keys)
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    grouped = f"(SELECT {listed}, count(*) AS n FROM {table} GROUP BY {listed})"
    total = "CAST(coalesce(sum(n), 0) AS BIGINT)"
    distinct = f"count(*) FILTER (WHERE {complete})"
    if len(keys) == 1:
        name = keys[0].lower()
        columns = f"{distinct} AS distinct_{name}, {total} - {distinct} AS duplicate_{name}"
    else:
        columns = (
            f"count(DISTINCT {keys[0]}) AS distinct_{keys[0].lower()}, {distinct} AS distinct_key_combo, "
            f"{total} - {distinct} AS duplicate_key_combo"
        )
    return f"SELECT {total} AS row_count, {columns} FROM {grouped}"


def orphan_count(table: str, key: str, parents: Sequence[tuple[str, str]]) -> str:
    known = " UNION ALL ".join(f"SELECT {k} AS k FROM {t}" for t, k in parents)
    return (
        f"SELECT count(*) AS orphan_{key.lower()}_count FROM {table} c "
        f"WHERE NOT EXISTS (SELECT 1 FROM ({known}) p WHERE p.k = c.{key})"
    )


def class_balance(table: str, column: str) -> str:
    total = f"(SELECT count(*) FROM {table})"
    return (
        f"SELECT {column}, count(*) AS row_count, {percent('count(*)', total)} AS pct_of_total "
        f"FROM {table} GROUP BY {column}"
    )


def value_counts(table: str, column: str) -> str:
    return f"SELECT {column}, count(*) AS row_count FROM {table} GROUP BY {column}"


def category_counts(table: str, columns: Sequence[str]) -> str:
    texts = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    names = ", ".join(f"'{c}'" for c in columns)
    return (
        "SELECT column_name, value, count(*) AS row_count FROM "
        f"(SELECT unnest([{names}]) AS column_name, unnest([{texts}]) AS value FROM {table}) "
        "GROUP BY column_name, value"
    )


def stats(alias: str, value: str, which: Sequence[str] = ("min", "max", "avg"), digits: int = 4) -> str:
    """Bounds and the average, the latter rounded because sums of doubles depend on their order."""
    shown = {
        "min": f"min({value}) AS min_{alias}",
        "max": f"max({value}) AS max_{alias}",
        "avg": f"round(avg(CAST({value} AS DOUBLE)), {digits}) AS avg_{alias}",
    }
    return ", ".join(shown[w] for w in which)


def sentinel_stats(alias: str, column: str, sentinel: float, which: Sequence[str] = ("min", "max")) -> str:
    real = f"NULLIF({column}, {sentinel})"
    shown = ", ".join(
        (f"round(avg(CAST({real} AS DOUBLE)), 4)" if w == "avg" else f"{w}({real})")
        + f" AS {w}_{alias}_excl_sentinel"
        for w in which
    )
    return f"{ones(f'{column} = {sentinel}')} AS {alias}_sentinel_count, {shown}"
