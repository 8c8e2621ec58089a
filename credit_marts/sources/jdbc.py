"""Relational sources over JDBC, read in parallel ranges of a numeric key."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from credit_marts.sources.landing import land
from credit_marts.sources.tables import counted


@dataclass(frozen=True)
class KeyRange:
    """How a table is split between tasks: ``tasks`` ranges of ``column`` from ``low`` to ``high``.

    The bounds only place the cuts; rows outside of them are read by the first and last task.
    ``tasks`` also bounds the number of connections the source has to serve at a time.
    """

    column: str
    low: int
    high: int
    tasks: int = 8


def quoted(identifier: str) -> str:
    """SQL identifier that keeps its casing."""
    return '"' + identifier.replace('"', '""') + '"'


def jdbc_options(
    url: str,
    table: str,
    split: KeyRange | None = None,
    fetch_rows: int = 10_000,
    connection: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a whole-table read; filters and column choices are pushed down by Spark."""
    options = {"url": url, "dbtable": quoted(table), "fetchsize": str(fetch_rows), **(connection or {})}
    if split:
        options |= {
            "partitionColumn": split.column,  # Spark quotes it
            "lowerBound": str(split.low),
            "upperBound": str(split.high),
            "numPartitions": str(split.tasks),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, split: KeyRange | None, **kw) -> DataFrame:
    """A relational table as a DataFrame, one task per key range. ``split`` None reads the table by
    one connection in one task, which is for small tables only and has to be said."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, split, **kw)).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, tasks: int = 8, connection: Mapping[str, str] | None = None
) -> int:
    """Replace a relational table by ``df`` over at most ``tasks`` connections; returns the rows written."""
    observed, rows = counted(df)
    (
        observed.write.format("jdbc")
        .options(url=url, dbtable=quoted(table), numPartitions=str(tasks), **(connection or {}))
        .mode("overwrite")
        .save()
    )
    return rows()


def land_all(
    spark: SparkSession, url: str, root: str, splits: Mapping[str, KeyRange | None], **kw
) -> dict[str, int]:
    """Extract the tables of ``splits`` one after another, each by its key range, and land them as
    Parquet; returns the rows per table. None says that a table is small enough for one task."""
    return {t: land(read_jdbc(spark, url, t, split, **kw), root, t) for t, split in splits.items()}
