"""Parquet landing zone: one directory per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credit_marts.sources.spec import TableSpec
from credit_marts.sources.tables import counted


def read_landing(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Scan of a landed table. The schema is that of the files."""
    return spark.read.parquet(spec.landing_path)


def land(df: DataFrame, root: str, table: str) -> int:
    """Replace ``root/table`` by ``df`` as snappy Parquet and return the number of rows written.

    The files keep the partitioning of ``df``: nothing is gathered into one file.
    """
    observed, rows = counted(df)
    observed.write.mode("overwrite").option("compression", "snappy").parquet(f"{root.rstrip('/')}/{table}")
    return rows()
