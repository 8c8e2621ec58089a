"""CSV files with a header, read with explicit types."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credit_marts.sources.tables import write_table

# An unquoted empty field is NULL; a quoted empty field and the text NA are values. Spark reads
# a quoted empty field as NULL when nullValue is empty too, hence a value no file contains.
_NO_SUCH_TEXT = "\u0001null\u0001"

# Column type by column name, first match wins.
NAME_RULES: tuple[tuple[str, T.DataType], ...] = (
    (r"SK_(ID_\w+|BUREAU_ID|DPD\w*)", T.LongType()),
    (r"TARGET|MONTHS_BALANCE|NUM_INSTALMENT_NUMBER|CNT_CHILDREN", T.LongType()),
    (r"AMT_CREDIT_LIMIT_ACTUAL|CREDIT_DAY_OVERDUE|CNT_CREDIT_PROLONG|SELLERPLACE_AREA", T.LongType()),
    (r"CNT_DRAWINGS_CURRENT", T.LongType()),
    (r"DAYS_(BIRTH|EMPLOYED|ID_PUBLISH|DECISION|CREDIT|CREDIT_UPDATE)", T.LongType()),
    (r"HOUR_\w+|REGION_RATING_\w+|(REG|LIVE)_(REGION|CITY)_NOT_\w+", T.LongType()),
    (r"FLAG_(OWN_CAR|OWN_REALTY|LAST_APPL_PER_CONTRACT)", T.StringType()),
    (r"NFLAG_INSURED_ON_APPROVAL", T.DoubleType()),
    (r"N?FLAG_\w+", T.LongType()),
    (r"(HOUSETYPE|WALLSMATERIAL|EMERGENCYSTATE|FONDKAPREMONT)_MODE", T.StringType()),
    (r"(AMT|CNT|DAYS|RATE|NUM|EXT_SOURCE|OBS|DEF|OWN_CAR_AGE|REGION_POPULATION)(_\w+)?", T.DoubleType()),
    (r"\w+_(AVG|MODE|MEDI)", T.DoubleType()),
)


def named_types(columns: list[str]) -> T.StructType:
    """Schema of a credit table from its header by ``NAME_RULES``; other names are text."""

    def type_of(column: str) -> T.DataType:
        for pattern, data_type in NAME_RULES:
            if re.fullmatch(pattern, column):
                return data_type
        return T.StringType()

    return T.StructType([T.StructField(c, type_of(c)) for c in columns])


# Texts the CSV reader takes as a whole and as any number: no spaces, no names of numbers.
_WHOLE = r"^[+-]?\d+$"
_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | None, lines: bool, corrupt: str | None = None
) -> DataFrame:
    """``lines``: a quoted field may hold line breaks, so that a file cannot be split among tasks.
    ``corrupt`` names the column of the schema that keeps a line that does not fit; without one such
    a line fails the read."""
    reader = (
        spark.read.option("header", True)
        .option("nullValue", _NO_SUCH_TEXT)
        .option("escape", '"')
        .option("mode", "PERMISSIVE" if corrupt else "FAILFAST")
        .option("multiLine", lines)
        .option("enforceSchema", False)  # the header of every file must name the columns in order
    )
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return (reader.schema(schema) if schema else reader).csv(path)


def _header(spark: SparkSession, path: str, lines: bool) -> list[str]:
    return scan_csv(spark, path, None, lines).columns


def infer_types(
    spark: SparkSession, path: str, sample_rows: int | None = None, lines: bool = False
) -> T.StructType:
    """Schema from the values: whole numbers without NULL are BIGINT, other numbers DOUBLE,
    true/false BOOLEAN, everything else text. What counts as a number is what the reader can parse.

    One aggregation over all rows. With ``sample_rows`` only over the first ones; then a later row
    that does not fit makes the read fail.
    """
    names = _header(spark, path, lines)
    text = scan_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in names]), lines)
    sample = text if sample_rows is None else text.limit(sample_rows)

    def fits(column: str, data_type: str) -> Column:
        value = F.col(f"`{column}`")
        pattern = _WHOLE if data_type == "bigint" else _NUMBER
        return F.count(F.when(value.rlike(pattern), value.try_cast(data_type)))

    checks = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(text.columns):
        checks.append(F.count(F.col(f"`{c}`")).alias(f"{i}_present"))
        checks.append(fits(c, "bigint").alias(f"{i}_whole"))
        checks.append(fits(c, "double").alias(f"{i}_number"))
        checks.append(
            F.count_if(F.lower(F.col(f"`{c}`")).isin("true", "false")).alias(f"{i}_truth")
        )
    seen = sample.agg(*checks).first()

    def type_of(i: int) -> T.DataType:
        present = seen[f"{i}_present"]
        if present == 0:
            # a column of NULLs may hold numbers; a file without rows says nothing
            return T.DoubleType() if seen["rows"] else T.StringType()
        if present == seen["rows"] == seen[f"{i}_whole"]:
            return T.LongType()
        if present == seen[f"{i}_number"]:
            return T.DoubleType()
        if present == seen["rows"] == seen[f"{i}_truth"]:
            return T.BooleanType()
        return T.StringType()

    return T.StructType([T.StructField(c, type_of(i)) for i, c in enumerate(text.columns)])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    lines: bool = False,
) -> DataFrame:
    """CSV with header as a DataFrame of explicit types.

    The schema is the given one, else inferred from all values (``infer``), else from the names.
    A value that does not fit its type fails the read, and so does a file whose header has other
    columns or another order. ``lines``: quoted fields may hold line breaks.
    """
    return scan_csv(spark, path, schema or csv_schema(spark, path, infer, lines), lines)


def csv_schema(spark: SparkSession, path: str, infer: bool = False, lines: bool = False) -> T.StructType:
    """From all values, or from the names in the header."""
    return infer_types(spark, path, lines=lines) if infer else named_types(_header(spark, path, lines))


def csv_to_table(
    spark: SparkSession,
    path: str,
    table: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    fmt: str = "parquet",
    lines: bool = False,
) -> int:
    """Replace ``table`` by the rows of a CSV and return how many were loaded."""
    return write_table(read_csv(spark, path, schema, infer, lines), table, fmt)
