"""Jump hashing: the law of keys, balance, and slots without gaps."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from credit_marts.llm import jump_hash


def direct(key, shards):
    """The published loop, with whole numbers."""
    place, target = -1, 0
    while target < shards:
        place = target
        key = (key * 2862933555777941757 + 1) % 2**64
        target = int((place + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return place


def test_every_key_goes_where_the_loop_sends_it():
    chance = random.Random(1)
    keys = [chance.getrandbits(64) for _ in range(2000)] + [0, 1, 2**64 - 1]
    for shards in (1, 2, 8, 9, 1000):
        assert jump_hash.jump(np.array(keys, dtype=np.uint64), shards).tolist() == [direct(k, shards) for k in keys]


def test_table(spark):
    docs = [(i, f"text {i}" if i % 9 else None) for i in range(4000)] + [(None, "é"), (None, None), (5, "text 5")]
    frame = spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id bigint, text string, shard int")
    rows = jump_hash.sharded(frame.repartition(6)).collect()
    assert len(rows) == len(docs)
    texts = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in docs)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == texts
    for shard in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots))) and 350 < len(slots) < 650
    assert all(r["grown_shard"] in (r["shard"], 8) and r["law"] == "key" for r in rows)
    assert 300 < sum(r["grown_shard"] == 8 for r in rows) < 600
    again = {r["id"]: r["shard"] for r in jump_hash.sharded(frame.where("doc_id % 2 = 0")).collect()}
    assert all(again[r["id"]] == r["shard"] for r in rows if r["id"] in again)
    assert jump_hash.sharded(frame.limit(0)).collect() == []


def test_other_keys(spark):
    frame = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 5).cast("string").alias("host"))
    rows = jump_hash.sharded(frame, key_col="host").collect()
    assert len({(r["id"] % 5, r["shard"]) for r in rows}) == 5
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted(set((r["shard"], r["slot"]) for r in rows))
