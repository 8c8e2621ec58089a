"""Rows that cannot be used, beside the table instead of in it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_marts.operators.checks import Rule
from credit_marts.operators.conform import misfits, standardize_types
from credit_marts.sources.csv_files import csv_schema, scan_csv
from credit_marts.sources.tables import publish_folder, recover

REASON, SOURCE, LINE = "reject_reason", "reject_source", "reject_line"


def with_reasons(df: DataFrame, types: Mapping[str, str] | None = None, rules: Sequence[Rule] = ()) -> DataFrame:
    """``df`` in its types, with what breaks a cast or a rule in REASON, NULL for a sound row.

    A value that does not fit its type becomes NULL as in ``standardize_types``; rules look at the
    values after that. A line that did not fit a CSV schema (see ``read_quarantined_csv``) is one
    reason more.
    """
    types = types or {}
    marks = {f"_misfit_{c}": fails for c, fails in misfits(df, types).items()}
    reasons = [F.when(F.col(LINE).isNotNull(), F.lit("malformed line"))] if LINE in df.columns else []
    reasons += [F.when(F.col(m), F.lit(f"cast({m.removeprefix('_misfit_')})")) for m in marks]
    reasons += [F.when(F.coalesce(rule.fails, F.lit(False)), F.lit(rule.name)) for rule in rules]
    found = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    typed = standardize_types(df.withColumns(marks), types)
    return typed.withColumn(REASON, F.when(found != "", found)).drop(*marks)


def read_quarantined_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False, lines: bool = False
) -> DataFrame:
    """A CSV as ``read_csv`` gives it, but a line that does not fit stays in the result: with NULL for
    what could not be read, the line itself in LINE, and its file in SOURCE, as for every row."""
    schema = schema or csv_schema(spark, path, infer, lines)
    whole = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    rows = scan_csv(spark, path, whole, lines, corrupt=LINE)
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE))


def write_quarantined(
    df: DataFrame,
    name: str,
    path: str,
    types: Mapping[str, str] | None = None,
    rules: Sequence[Rule] = (),
    fmt: str = "parquet",
) -> tuple[int, int]:
    """Replace table ``name`` by the sound rows of ``df`` and ``<name>__rejected`` by the others with
    their reasons; returns how many went where.

    Both are written in one pass over ``df``, divided by folder, and counted on top of the plan. The
    folders are published one after the other, each as ``write_table`` publishes a place of its own:
    ``path`` and ``<path>__rejected``. No row is lost: what was read is kept or rejected.
    """
    spark, staging, rejects = df.sparkSession, f"{path}__staging", f"{path}__rejected"
    recover(spark, name, path)
    recover(spark, f"{name}__rejected", rejects)
    marked = with_reasons(df, types, rules)
    marked = marked.withColumn("_rejected", F.col(REASON).isNotNull())
    seen = Observation()
    counted = marked.observe(seen, F.count_if("_rejected").alias("rejected"), F.count(F.lit(1)).alias("rows"))
    counted.write.format(fmt).mode("overwrite").partitionBy("_rejected").save(staging)
    found = seen.get
    columns = [c for c in marked.columns if c != "_rejected"]
    sound = [c for c in columns if c not in (REASON, SOURCE, LINE)]
    for target, place, kept, flag in ((name, path, sound, "false"), (f"{name}__rejected", rejects, columns, "true")):
        folder = f"{staging}/_rejected={flag}"
        publish_folder(spark, folder, target, fmt, place, marked.select(*kept).schema)
    return int(found["rows"] - found["rejected"]), int(found["rejected"])
