"""Packing: the curve, and every token in exactly one place."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from credit_marts.llm import curve_pack

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("dims", [2, 3])
def test_curve_visits_neighbours(dims):
    side = np.arange(8)
    points = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = curve_pack.hilbert(points, 3)
    assert sorted(keys.tolist()) == list(range(8**dims))
    walk = points[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_similar_documents_are_near_on_the_curve():
    project, chance = curve_pack.Projector(1 << 16), np.random.default_rng(1)
    pools = [chance.integers(0, 50_000, 300) for _ in range(12)]
    def near(pool):  # nineteen twentieths of the tokens are those of the pool
        return np.concatenate([pool[:285], chance.integers(0, 50_000, 15)])

    vectors = np.array([project.vector(near(pool)) for pool in pools for _ in range(8)])
    order = np.argsort(curve_pack.hilbert(project.grid(vectors), curve_pack.BITS), kind="stable") // 8
    assert (np.diff(order) == 0).mean() > 0.6  # at random 0.07


@pytest.mark.parametrize("parts", [1, 4])
def test_pieces(spark, parts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    docs = [(i, f"document {i} about  things\n{i * i}" * (i % 7)) for i in range(300)]
    docs += [(1000 + i, "one of many copies") for i in range(200)]
    docs += [(2000, None), (2001, ""), (2002, "long text " * 20_000), (2003, "<|endoftext|> é🎉")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, part int, key string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = curve_pack.pack(frame.repartition(5), RANKS, public_tokenizers.PATTERN, length=1024).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in docs}
    for i, own in ids.items():
        pieces = sorted((r for r in rows if r["id"] == i), key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == own
        for r in pieces:
            part = own[r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == len(own)
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    used = []
    for _, own in sorted(sequences.items()):
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        used.append(at)
    assert sorted(sequences) == list(range(len(used)))
    assert all(u == 1024 for u in used[:-1]) and sum(used) == sum(map(len, ids.values()))


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id bigint, text string")
    rows = curve_pack.pack(frame, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r["id"]), r["length"]) for r in rows) == [("1", 2), ("1", 2), ("None", 2)]
    assert curve_pack.pack(frame.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
