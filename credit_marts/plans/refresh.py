"""A fact kept up to date by parts: only the applicants whose inputs changed are built anew."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.sources.tables import read_table, write_table

PART = "fact_part"
_DIGESTS = f"{PART} int, input string, row_count bigint, digest bigint, total bigint"


def part_of(key: Column | str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def input_digests(inputs: Mapping[str, DataFrame], key: str, parts: int) -> DataFrame:
    """(part, input, row_count, digest, total): what the rows of each part of each input hash to,
    whatever order they come in. Rows are folded inside tasks before the exchange."""

    def one(name: str, df: DataFrame) -> DataFrame:
        row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
        return df.select(part_of(key, parts).alias(PART), row.alias("row")).groupBy(PART).agg(
            F.count(F.lit(1)).alias("row_count"), F.bit_xor("row").alias("digest"),
            F.sum(F.pmod("row", F.lit(1 << 32))).alias("total"),
        ).select(PART, F.lit(name).alias("input"), "row_count", "digest", "total")

    return reduce(DataFrame.unionAll, [one(name, df) for name, df in inputs.items()])


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for one write: ``insertInto`` takes it from nowhere else."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def refresh_fact(
    spark: SparkSession,
    name: str,
    inputs: Mapping[str, DataFrame],
    build: Callable[[Mapping[str, DataFrame]], DataFrame],
    key: str = "SK_ID_CURR",
    parts: int = 256,
) -> list[int]:
    """Bring the stored fact ``name`` up to date and return the parts that were written.

    ``inputs`` are the applications and dimensions, each with the column ``key``; ``build`` makes the
    fact of them, row by row of ``key``, so it may be given a part of the keys alone. A digest per
    part and input is compared with the one stored by the last refresh; parts that differ are read,
    built and replaced by a dynamic partition overwrite, and parts without rows are dropped. A fact
    that is not there, or has other columns or another number of parts, is built as a whole.

    Digests are stored last: a refresh that dies before that does the same parts again. The driver
    sees one row per part and input.
    """
    digests, found = f"{name}__digests", input_digests(inputs, key, parts).collect()
    sample = build(inputs).withColumn(PART, part_of(key, parts))
    stored = None
    if spark.catalog.tableExists(name) and spark.catalog.tableExists(digests):
        stored = {(r[PART], r["input"]): tuple(r) for r in read_table(spark, digests).collect()}
    new = {(r[PART], r["input"]): tuple(r) for r in found}
    settings = (-1, f"{parts} {sorted(sample.dtypes)}")
    mark = (*settings, 0, 0, 0)
    changed = sorted({p for p, _ in new})
    whole = stored is None or stored.get(settings) != mark
    if whole:
        sample.write.mode("overwrite").partitionBy(PART).saveAsTable(name)
    else:
        changed = sorted({k[0] for k in {*new, *stored} if new.get(k) != stored.get(k) and k != settings})
        if not changed:
            return []
        some = {n: df.where(part_of(key, parts).isin(changed)) for n, df in inputs.items()}
        rows = build(some).withColumn(PART, part_of(key, parts)).select(*spark.table(name).columns)
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.write.insertInto(name, overwrite=True)
        present = {r[PART] for r in spark.table(name).where(F.col(PART).isin(changed)).select(PART).distinct().collect()}
        built = {r[PART] for r in rows.select(PART).distinct().collect()}
        for gone in sorted(present - built):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PART} = {gone})")
    write_table(spark.createDataFrame([*new.values(), mark], _DIGESTS).coalesce(1), digests)
    spark.catalog.refreshTable(name)
    return changed
