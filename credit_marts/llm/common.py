"""What the operators share: shipped code, stored steps, batches of texts, tables of words."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.sources import work_dir

# Zipped packages by application; executors fetch them from the driver for as long as it lives.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}

# Characters of text that are handled at a time: bounds the lists of words in a worker.
CHUNK_CHARS = 2_000_000


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session's cluster, once."""
    context: SparkContext = spark.sparkContext
    if context.applicationId not in _shipped:
        package, folder = Path(__file__).resolve().parent.parent, tempfile.TemporaryDirectory()
        code = f"{folder.name}/code"
        shutil.copytree(package, f"{code}/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder.name}/{package.name}", "zip", code))
        _shipped[context.applicationId] = folder


def arrow_map(
    df: DataFrame, batches: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with the package shipped."""
    ship(df.sparkSession)
    return df.mapInArrow(batches, schema)


class Steps:
    """Intermediate tables of one call, below the shared folder of the session."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.number = spark, work_dir(spark), 0

    def store(self, df: DataFrame, codec: str = "snappy") -> DataFrame:
        """``df`` written and read again: later steps neither repeat nor lose it."""
        self.number += 1
        path = f"{self.folder}/step{self.number}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranges(spark: SparkSession, units: int, each: int = 2_000_000) -> int:
    """How many ranges to sort ``units`` (rows, tokens, bytes) in: they grow with the data, so that one
    range stays at about ``each``, and are no fewer than the session's shuffle partitions."""
    return max(partitions(spark), -(-units // each))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under names of its own; a missing text is empty."""
    return df.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about CHUNK_CHARS bytes of text; one text is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // CHUNK_CHARS
    starts = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else []
    for begin, end in zip(starts, [*starts[1:], len(group)], strict=True):
        yield batch.slice(begin, end - begin)


def sample_share(rows: int, bound: int) -> float:
    """The share of ``rows`` that leaves about ``bound`` of them."""
    return min(1.0, bound / rows) if rows else 1.0


def hashed_share(column: str, share: float):
    """A condition that holds for about this share of the values, the same ones on every run."""
    return F.pmod(F.xxhash64(F.col(column), F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000)


def crc_bucket(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; the fold of a row."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


# What the operators keep in a worker: the tables of one of them at a time, by operator and model.
_held: dict[tuple, object] = {}

# Bytes that one operator's tables may take in a worker. Texts, slots and rows are counted, not
# characters alone.
TABLE_BYTES = 96 << 20
_SLOT = 110  # of a dictionary entry and a small number


def per_worker(operator: str, model: object, make: Callable[[], object]):
    """The tables of an operator in this worker, made once per model.

    Workers outlive stages. What other operators, or other models of this one, have left behind is
    dropped first, so a worker never holds the tables of two stages.
    """
    key = (operator, model)
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make()
    return _held[key]


class Kept(dict):
    """Values by text, worked out once, in about ``most`` bytes.

    When half of them are used, the values are set aside, where they are found again as long as they
    are needed; those that are not go the next time. So frequent texts stay.
    """

    def __init__(self, make: Callable[[str], object], most: int = TABLE_BYTES) -> None:
        super().__init__()
        self.make, self.most, self.bytes, self.aside = make, most, 0, {}

    def __missing__(self, text: str) -> object:
        if 2 * self.bytes > self.most:
            self.aside = dict(self)
            self.clear()
            self.bytes = 0
        value = self.aside.pop(text) if text in self.aside else self.make(text)
        self[text] = value
        inner = sum(map(getsizeof, value)) if type(value) is tuple else 0
        self.bytes += getsizeof(text) + getsizeof(value) + inner + _SLOT
        return value


class WordTable:
    """Values per distinct word, computed once per worker; emptied when they take more than ``most``
    bytes.

    ``fill`` gets the words that are new and returns their values, one row per word.
    """

    def __init__(self, fill: Callable[[list], np.ndarray], most: int = TABLE_BYTES) -> None:
        self.fill, self.most = fill, most
        self.forget()

    def forget(self) -> None:
        self.rows: dict = {}
        self.values = self.fill([])
        self.bytes = 0

    def __call__(self, words: list) -> np.ndarray:
        """The row of every word in ``values``."""
        if self.bytes > self.most:
            self.forget()
        new = list(set(words).difference(self.rows))
        if new:
            at, end = len(self.rows), len(self.rows) + len(new)
            self.rows.update(zip(new, range(at, end), strict=True))
            row = 2 * self.values.itemsize * int(np.prod(self.values.shape[1:], dtype=np.int64))  # with room to grow
            self.bytes += sum(map(getsizeof, new)) + (_SLOT + row) * len(new)
            if end > len(self.values):
                room = np.zeros((2 * end, *self.values.shape[1:]), self.values.dtype)
                room[:at] = self.values[:at]
                self.values = room
            self.values[at:end] = self.fill(new)
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
