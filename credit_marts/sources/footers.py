"""Questions that file footers answer: rows, and bounds of plain columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def footer_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files, read such that Spark pushes COUNT, MIN and MAX into their footers.

    The frame belongs to a session of its own with the settings this needs, so the caller's session
    plans as before; it cannot be joined to frames of that one. Whether an aggregate is pushed down
    is the planner's decision: one over an expression, over text or beside a filter or an average is
    computed from the rows as usual, with the same result.
    """
    session = spark.newSession()
    others = [s for s in session.conf.get("spark.sql.sources.useV1SourceList", "").split(",") if s.strip() != "parquet"]
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path)
