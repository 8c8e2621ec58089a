"""Packing along a space-filling curve: similar documents share sequences.

Token counts of a document, hashed with signs into a vector and projected to three dimensions, give
its place on a Hilbert curve. Rows are range-sorted by that place; the tokens of all documents in
this order, each ended by id 0, are cut every ``length`` tokens, so only the very last sequence is
not full. Splitters are quantiles of all keys by tokens; a hash of the id in the low bits of the key splits
groups of equal documents between partitions. The first position of a partition is the sum of the
token counts of the partitions before it, one number for each.

A null text counts as empty; an empty text is its end id alone. Repeated rows and ids, null ids
included, are packed each on its own. An empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.byte_bpe import library_encoder
from credit_marts.llm.common import Steps, arrow_map, ranges, slices, texts
from credit_marts.llm.minhash import mixed

DIMS, BITS = 3, 14  # of the curve
TIE_BITS = 20
HASHED = 256  # dimensions of the hashed vectors
TOKENS_A_RANGE = 16_000_000


def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with coordinates of ``bits`` bits, one per row."""
    x = places.astype(np.int64).T.copy()
    dims = len(x)
    step = 1 << (bits - 1)
    while step > 1:  # undo the turns of the cells, from the largest
        low = step - 1
        for i in range(dims):
            turned = (x[i] & step) != 0
            swapped = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swapped)
            x[i] ^= swapped
        step >>= 1
    for i in range(1, dims):  # Gray code across the dimensions
        x[i] ^= x[i - 1]
    flips, step = np.zeros_like(x[0]), 1 << (bits - 1)
    while step > 1:
        flips = np.where(x[dims - 1] & step, flips ^ (step - 1), flips)
        step >>= 1
    x ^= flips
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> bit) & 1
    return key


class Projector:
    """Token ids to coordinates on the grid of the curve."""

    def __init__(self, vocabulary: int) -> None:
        bits = mixed(np.arange(1, vocabulary + 1, dtype=np.uint64))
        self.cell = (bits % np.uint64(HASHED)).astype(np.int64)
        self.sign = np.where(bits >> np.uint64(63), 1.0, -1.0)
        self.axes = np.random.default_rng(5).standard_normal((HASHED, DIMS))

    def vector(self, ids: np.ndarray) -> np.ndarray:
        return np.bincount(self.cell[ids], weights=self.sign[ids], minlength=HASHED)

    def grid(self, vectors: np.ndarray) -> np.ndarray:
        norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        spread = 1 / (1 + np.exp(-1.702 * (vectors / norms) @ self.axes))
        return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def encoded(docs: DataFrame, ranks_path: str, pattern: str, end_id: int) -> DataFrame:
    """(id, tokens, key, ids) of the output of ``texts``; ids as little-endian bytes."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = library_encoder(ranks_path, pattern)
        end = np.array([end_id], units.width).tobytes()
        projector = Projector(1 << 16 if units.width.itemsize == 2 else 1 << 18)
        for batch in found:
            for part in slices(batch):
                data = [b"".join(units.of(t)) + end for t in part["text"].to_pylist()]
                if not data:
                    continue
                vectors = np.array([projector.vector(np.frombuffer(d, units.width)) for d in data])
                tie = [xxhash.xxh3_64_intdigest(str(i)) >> (64 - TIE_BITS) for i in part["id"].to_pylist()]
                key = hilbert(projector.grid(vectors), BITS) << TIE_BITS | np.array(tie, np.int64)
                tokens = np.array([len(d) // units.width.itemsize for d in data], np.int64)
                columns = [part["id"], pa.array(tokens), pa.array(key), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "tokens", "key", "ids"])

    return arrow_map(docs, batches, "id bigint, tokens bigint, key bigint, ids binary")


def pack(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    length: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences: (id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset) and, unless told otherwise, their ids."""
    spark = docs.sparkSession
    steps = Steps(spark)
    rows = steps.store(encoded(texts(docs, id_col, text_col), ranks_path, pattern, end_id), codec="zstd")
    total = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    parts = ranges(spark, total, TOKENS_A_RANGE)
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)] or [F.lit(0.5)])
    # A key counts once for every sequence its document fills, so that ranges balance tokens.
    keys = rows.select("key", F.explode(F.sequence(F.lit(1), F.ceil(F.col("tokens") / length))))
    cuts = keys.agg(F.percentile_approx("key", shares, max(10_000, 20 * parts)).alias("cuts")).first()["cuts"] or []
    cuts = F.array(*[F.lit(cut).cast("bigint") for cut in (cuts if parts > 1 else [])]).cast("array<bigint>")
    placed = rows.withColumn("part", F.size(F.filter(cuts, lambda cut: cut <= F.col("key"))))
    totals = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}
    begins, at = {}, 0  # one number per partition
    for part in sorted(totals):
        begins[part], at = at, at + totals[part]

    def pieces(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = library_encoder(ranks_path, pattern).width
        position = None
        for batch in found:
            out, own = [], []
            for i, part, data in zip(
                batch["id"].to_pylist(), batch["part"].to_pylist(), batch["ids"].to_pylist(), strict=True
            ):
                position = begins[part] if position is None else position
                ids, start = np.frombuffer(data, width).astype("<u4"), 0
                while start < len(ids):
                    sequence, offset = divmod(position, length)
                    piece = ids[start : start + length - offset]
                    out.append((i, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), sequence, offset))
                    own.append(piece)
                    start, position = start + len(piece), position + len(piece)
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 7
            if with_ids:
                ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
                flat = np.concatenate(own).astype(np.int32) if own else np.array([], np.int32)
                columns.append(pa.ListArray.from_arrays(ends, flat))
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = ", ".join(f"`{n}` bigint" for n in names[:7]) + (", ids array<int>" if with_ids else "")
    dealt = placed.repartitionById(parts, F.col("part")).sortWithinPartitions("key", "id", "ids")
    return arrow_map(dealt.select("id", "part", "ids"), pieces, schema)
