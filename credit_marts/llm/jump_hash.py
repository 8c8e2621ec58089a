"""Sharding by jump consistent hashing: the key and the number of shards decide, no table of a ring.

A key walks through the shard counts at which it would move and stays at the last one below the
number of shards, so a further shard takes rows into itself only. Slots number the rows of a shard
without a gap: rows are counted by (bucket, shard), and a row's place among its bucket's rows is
added to the counts of the buckets before. A null key is a key like any other; repeated rows get
slots of their own. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from credit_marts.llm.common import Steps, partitions, ship

# Fixed value: the multiplier of the published algorithm's generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key."""
    state, place = keys.astype(np.uint64), np.zeros(len(keys), dtype=np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        drawn = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        target = ((place[moving] + 1) * (float(1 << 31) / drawn)).astype(np.int64)
        moving, target = moving[target < shards], target[target < shards]
        place[moving] = target
    return place


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key column of any type, by its stable 64-bit hash."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy().view(np.uint64), shards).astype(np.int32))

    return shard(F.xxhash64(key))


def sharded(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row; ``grown_shard`` is the
    shard with one more of them. ``key_col`` decides, the id if none is given."""
    ship(docs.sparkSession)
    steps, buckets = Steps(docs.sparkSession), partitions(docs.sparkSession)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(F.col(key_col or id_col), shards).alias("shard"),
        shard_of(F.col(key_col or id_col), shards + 1).alias("grown_shard"),
    )
    rows = rows.withColumn(
        "bucket", F.pmod(F.xxhash64("id", "text_crc32", F.monotonically_increasing_id()), F.lit(buckets))
    )
    rows = steps.store(rows)
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(begins), ["shard", "bucket"]).select(  # shards times buckets rows
        "id", "size", "text_crc32", "law", "shard", (F.col("begin") + F.col("place")).alias("slot"), "grown_shard"
    )
