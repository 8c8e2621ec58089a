"""The ledger of a run: which tables it has published from which inputs, so that a run that was cut
short goes on where it stopped."""

from __future__ import annotations

import datetime
import hashlib
import uuid
from threading import Lock

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from credit_marts.sources.tables import read_table, write_table

_COLUMNS = "run_id string, target string, fingerprint string, row_count bigint, at timestamp"
FINISHED = ""  # stands for the run as a whole


def files_fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when a file below ``path`` is added, removed or written again. Only names, lengths and
    times are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = files.select(F.xxhash64("path", "length", "modificationTime").alias("hash"), "length").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.bit_xor("hash"), F.lit(0))
    )
    return fingerprint(*found.first())


def fingerprint(*parts: object) -> str:
    """A short digest of inputs and parameters."""
    return hashlib.sha256("\0".join(map(str, parts)).encode()).hexdigest()[:32]


class RunLedger:
    """Rows (run, table, fingerprint of its inputs, rows written), one appended with each publication.

    A ledger whose last run has not finished continues it; otherwise, or without ``resume``, a new
    run begins. A table counts as published if this run published it from the same inputs and it
    still exists. A run that dies between a publication and its row publishes that table again.
    """

    def __init__(self, spark: SparkSession, name: str, resume: bool = True) -> None:
        self.spark, self.name, self._lock = spark, name, Lock()
        self.run_id, self._published = uuid.uuid4().hex, {}
        if resume and spark.catalog.tableExists(name):
            rows = read_table(spark, name).orderBy("at").collect()  # one row per table of the pipeline
            if rows and not any(r["run_id"] == rows[-1]["run_id"] and r["target"] == FINISHED for r in rows):
                self.run_id = rows[-1]["run_id"]
                self._published = {r["target"]: r for r in rows if r["run_id"] == self.run_id}

    def published(self, target: str, inputs: str) -> int | None:
        """The rows of ``target`` if this run has it already."""
        row = self._published.get(target)
        if row is None or row["fingerprint"] != inputs or not self.spark.catalog.tableExists(target):
            return None
        return row["row_count"]

    def record(self, target: str, inputs: str, rows: int) -> None:
        self._append([(self.run_id, target, inputs, rows, datetime.datetime.now())])

    def finish(self) -> None:
        """The run is complete; rows of earlier runs go."""
        self.record(FINISHED, "", 0)
        own = self.spark.table(self.name).where(F.col("run_id") == self.run_id)
        write_table(own.coalesce(1), self.name)

    def _append(self, rows: list[tuple]) -> None:
        with self._lock:  # two appends at once would share a folder for unfinished files
            found = self.spark.createDataFrame(rows, _COLUMNS).coalesce(1)
            found.write.mode("append").saveAsTable(self.name)
