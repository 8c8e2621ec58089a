"""Exact dedup by content sort: range partitions, external sorting, comparison of neighbours.

Texts are equal when identical after lower-casing A-Z only. Rows are ordered by the first bytes of
the normalised text, its sha256 and the id, largest first. A bounded sample of these keys gives the
splitters of the range partitions, Spark sorts each partition (spilling as needed), and every row is
compared in full with its neighbour. As the id is part of the key, copies that fill more than one
partition are split among several; the runs that touch a border are put together by their digests,
two per partition at most.

A null text counts as empty, and empty texts are equal. Of equal texts the row with the largest id
stays (a null id comes last; of rows equal in text and id, any one). An empty table gives an empty
table; other columns are carried along if asked for, under their own names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, arrow_map, partitions, sample_share

PREFIX = 16  # leading bytes of the normalised text in the sort key
SAMPLED = 40  # rows sampled for each partition to place the splitters
LEAST = -(2**63)


def normal(text: str) -> bytes:
    return text.encode().lower()


def _keys(batch: pa.RecordBatch) -> tuple[list[bytes], list[bytes], list[int]]:
    """Sort key of each row: prefix, digest, and the id so that larger ones come first."""
    plain = [normal(t or "") for t in batch["__text"].to_pylist()]
    ids = [LEAST if i is None else i for i in batch["__id"].to_pylist()]
    return [p[:PREFIX] for p in plain], [sha256(p).digest() for p in plain], [~i for i in ids]


def splitters(rows: DataFrame, parts: int) -> list[tuple[bytes, bytes, int]]:
    """Keys that cut the rows in about equal parts, from SAMPLED rows per part."""
    share = sample_share(rows.count(), SAMPLED * parts)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            columns = _keys(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64()), strict=True)],
                ["prefix", "digest", "back"],
            )

    sampled = rows if share >= 1 else rows.sample(share, seed=1)
    keys = sorted((bytes(a), bytes(b), c) for a, b, c in arrow_map(
        sampled, batches, "prefix binary, digest binary, back bigint").collect())
    return [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []


def _sorted_runs(
    df: DataFrame, id_col: str, text_col: str, carry: Sequence[str], steps: Steps
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their run of equal neighbours (partition, number), the runs, and the groups that
    cross a border of partitions: two runs per partition at most."""
    parts = partitions(df.sparkSession)
    names = [f"__c{i}" for i in range(len(carry))]
    rows = df.select(
        F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).alias("__text"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names, strict=True)],
    )
    cuts = splitters(rows.select("__id", "__text"), parts)

    def keyed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            prefix, digest, back = _keys(batch)
            part = [bisect_right(cuts, key) for key in zip(prefix, digest, back, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part, pa.int32()), pa.array(prefix, pa.binary()),
                 pa.array(digest, pa.binary()), pa.array(back, pa.int64())],
                [*batch.schema.names, "__part", "__prefix", "__digest", "__back"],
            )

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = arrow_map(rows, keyed, f"{own}, __part int, __prefix binary, __digest binary, __back bigint")
    dealt = dealt.repartitionById(parts, F.col("__part")).sortWithinPartitions("__prefix", "__digest", "__back")

    def compared(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last, first_id = -1, None, None
        for batch in found:
            runs, firsts, starts = [], [], []
            for digest, text, i in zip(
                batch["__digest"].to_pylist(), batch["__text"].to_pylist(), batch["__id"].to_pylist(), strict=True
            ):
                plain = normal(text or "")
                new = last is None or last[0] != digest or last[1] != plain
                if new:
                    run, last, first_id = run + 1, (digest, plain), i
                runs.append(run)
                firsts.append(first_id)
                starts.append(new)
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in ("__id", "__part", "__digest", *names)], pa.array(runs, pa.int64()),
                 pa.array(firsts, pa.int64()), pa.array(starts, pa.bool_())],
                ["__id", "__part", "__digest", *names, "__run", "__first", "__start"],
            )

    carried = "".join(f", `{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    schema = f"__id bigint, __part int, __digest binary{carried}, __run bigint, __first bigint, __start boolean"
    tagged = steps.store(
        arrow_map(dealt.drop("__prefix", "__back"), compared, schema), codec="zstd" if names else "snappy"
    )

    sizes = steps.store(
        tagged.groupBy("__part", "__run").agg(
            F.count(F.lit(1)).alias("size"), F.first("__first").alias("first"), F.first("__digest").alias("digest")
        )
    )
    last_run = sizes.groupBy("__part").agg(F.max("__run").alias("last"))
    border = sizes.join(F.broadcast(last_run), "__part").where("__run = 0 OR __run = last")  # a row per partition
    across = border.groupBy("digest").agg(
        F.sum("size").alias("all"), F.max("first").alias("keep"), F.min("__part").alias("home"), F.count("size").alias("n")
    )
    return tagged, sizes, steps.store(across.where("n > 1").drop("n"))


def content_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row."""
    tagged, sizes, across = _sorted_runs(df, id_col, text_col, (), Steps(df.sparkSession))
    whole = sizes.join(F.broadcast(across), "digest", "left").select(  # bounded by the partitions
        "__part", "__run", F.coalesce("all", "size").alias("group_size"), F.coalesce("keep", "first").alias("keep_id"),
        (F.col("home").isNull() | (F.col("home") == F.col("__part"))).alias("at_home"),
    )
    return tagged.join(whole, ["__part", "__run"]).select(
        F.col("__id").alias("id"), "keep_id", "group_size", (F.col("__start") & F.col("at_home")).alias("kept"),
        F.lower(F.hex("__digest")).alias("text_sha256"),
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns. Texts are exchanged once."""
    tagged, _, across = _sorted_runs(df, id_col, text_col, df.columns, Steps(df.sparkSession))
    ours = tagged.where("__start").join(  # bounded by the partitions
        F.broadcast(across.select(F.col("digest").alias("__digest"), "home")), "__digest", "left"
    )
    kept = ours.where("home IS NULL OR home = __part")
    return kept.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(df.columns)])
