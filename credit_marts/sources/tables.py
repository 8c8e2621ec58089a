"""Catalog tables: schemas, reads, counted overwrites, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")


def ensure_schemas(
    spark: SparkSession,
    catalog: str = "spark_catalog",
    layers: Sequence[str] = LAYERS,
    prefix: str = "",
    location: str | None = None,
) -> None:
    """Create the medallion schemas, safe to repeat. ``location`` holds their managed tables
    instead of the warehouse folder."""
    for layer in layers:
        place = f" LOCATION '{location}/{prefix}{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {catalog}.{prefix}{layer}{place}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan of a catalog table by its one-, two- or three-part name, put back first if a publication
    was cut short."""
    recover(spark, name)
    return spark.table(name)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """``df`` with a row counter that is filled by the action run on it.

    The counter sits on top of the plan, hence in the result stage of a write, where Spark
    counts a retried task once. No second scan and no metadata lookup is needed.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: int(seen.get["rows"])


# Whether the shuffle files of a query go when it ends, instead of when the driver's memory fills up.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries of the session that start in here leave no shuffle files behind. Each of them should
    run once, as every table is stored once: a second run of the same frame shuffles again."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


Check = Callable[[Mapping[str, int], DataFrame], None]


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    path: str | None = None,
    buckets: tuple[int, str] | None = None,
    counts: Mapping[str, Column] | None = None,
    check: Check | None = None,
    lookup: str | None = None,
) -> int:
    """Replace table ``name`` (rows and schema) by ``df`` and return the number of rows written.

    The rows go to a staging table first; while they are written, the aggregates in ``counts``
    (and ``rows``) are observed. ``check`` gets them and the staged table and raises when it must
    not be published. Until then the table holds what it held; a write or a check that fails
    leaves it as it was.

    ``path`` makes the table external. ``buckets`` = (number, column) stores it bucketed and
    sorted by a key that is unique in ``df``, so that later joins on it need no exchange; a key
    that repeats must not be used, since all its rows would be read by one task. ``lookup`` names a
    column whose values get Bloom filters in the files, for questions about single values.

    A run that dies before it publishes leaves the old table; one that dies while it does leaves it
    aside, where ``recover`` finds it, which every write and ``read_table`` call.
    """
    if fmt == "delta" and buckets:
        raise ValueError("a Delta table cannot be bucketed")
    spark, staging = df.sparkSession, f"{name}__staging"
    recover(spark, name, path)
    seen = Observation()
    dealt = df.repartition(*buckets) if buckets else df  # one file per bucket
    # On top of the plan, hence in the result stage, where Spark counts a retried task once.
    rows = dealt.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()])
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    try:
        _save(rows, staging, fmt, f"{path}__staging" if path else None, buckets, lookup)
        found = seen.get
        if check:
            check(found, spark.table(staging))
        if fmt == "delta":  # replaces atomically by itself
            _save(spark.table(staging), name, fmt, path, None, None)
            spark.sql(f"DROP TABLE {staging}")
        elif path:
            _publish_folder(spark, staging, name, fmt, path, buckets)
        else:
            _publish(spark, staging, name)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    return int(found["rows"])


def _save(
    df: DataFrame, name: str, fmt: str, path: str | None, buckets: tuple[int, str] | None, lookup: str | None
) -> None:
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "parquet":  # three layers hold much the same values: two thirds of the bytes of snappy
        writer = writer.option("compression", "zstd")
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    if lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def _bare(name: str) -> str:
    """A table's name as RENAME wants its target: without the catalog."""
    return name.partition(".")[2] if name.count(".") == 2 else name


def recover(spark: SparkSession, name: str, path: str | None = None) -> bool:
    """Put a table back that a run set aside and then died before it published the next one.

    Between the two renames of a publication the old rows exist under ``<name>__replaced`` only.
    Returns whether there was something to put back. A table that is published and still has its
    predecessor beside it keeps the new rows; the next publication drops the old ones.
    """
    if path:
        whole, aside = _folders(spark, path, f"{path}__replaced")
        if whole.exists() or not aside.exists():
            return False
        aside.rename(whole)
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)
        return True
    aside = f"{name}__replaced"
    if spark.catalog.tableExists(name) or not spark.catalog.tableExists(aside):
        return False
    spark.sql(f"ALTER TABLE {aside} RENAME TO {_bare(name)}")
    return True


def _publish(spark: SparkSession, staging: str, name: str) -> None:
    """Give the staged table its name. The table it replaces is set aside first, and put back if that
    fails, here or, when the driver dies in between, by ``recover``."""
    aside = f"{name}__replaced"
    replaces = spark.catalog.tableExists(name)
    if replaces:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {_bare(aside)}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {_bare(name)}")
    except BaseException:
        recover(spark, name)
        raise
    spark.catalog.refreshTable(name)
    spark.sql(f"DROP TABLE IF EXISTS {aside}")


def _publish_folder(
    spark: SparkSession, staging: str, name: str, fmt: str, path: str, buckets: tuple[int, str] | None
) -> None:
    """As ``_publish`` for a table at a place of its own. Rows are written once."""
    schema = spark.table(staging).schema
    spark.sql(f"DROP TABLE {staging}")  # external: the files stay
    publish_folder(spark, f"{path}__staging", name, fmt, path, schema, buckets)


def publish_folder(
    spark: SparkSession,
    staged_path: str,
    name: str,
    fmt: str,
    path: str,
    schema: T.StructType,
    buckets: tuple[int, str] | None = None,
) -> None:
    """A staged folder takes the place of a table, which is declared anew, as its columns may have
    changed. The folder it replaces is set aside until then."""
    staged, whole, aside = _folders(spark, staged_path, path, f"{path}__replaced")
    if not staged.exists():  # of a table without rows
        staged.create()
    if whole.exists():
        aside.delete()
        whole.rename(aside)
    try:
        staged.rename(whole)
    except BaseException:
        recover(spark, name, path)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    dealt = f"CLUSTERED BY ({buckets[1]}) SORTED BY ({buckets[1]}) INTO {buckets[0]} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {dealt} LOCATION '{path}'")
    aside.delete()


class _Folder:
    """A folder of any file system Spark can write to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.system.exists(self.path)

    def create(self) -> None:
        self.system.mkdirs(self.path)

    def delete(self) -> None:
        self.system.delete(self.path, True)

    def rename(self, to: _Folder) -> None:
        if not self.system.rename(self.path, to.path):
            raise OSError(f"cannot rename {self.path} to {to.path}")


def _folders(spark: SparkSession, *paths: str) -> list[_Folder]:
    return [_Folder(spark, path) for path in paths]


def work_dir(spark: SparkSession) -> str:
    """A new folder for the tables of one run, below the shared one named in ``spark.checkpoint.dir``.
    It is removed when the application ends, as the tables returned to a caller may read it.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        folder = f"{named.rstrip('/')}/credit-marts-{uuid.uuid4().hex}"
    elif spark.conf.get("spark.master", "").startswith("local"):
        folder = tempfile.mkdtemp(prefix="credit-marts-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder
