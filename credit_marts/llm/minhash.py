"""MinHash near-dedup: SuperMinHash signatures, bands, verified links, union-find groups.

A document is the set of its distinct word shingles. SuperMinHash gives every shingle a random
order of the signature's places; the shingle bids ``rank + random`` for the place it names at that
rank, and each place keeps the lowest bid. All shingles of a document bid rank by rank, and a
document stops as soon as no later rank can win a place any more.

Documents with equal sets form a class at once. Of the classes in a bucket of equal bands, each is
first compared with one leader; after that only members of different components are compared, so a
group of copies costs links in proportion to its size and no possible link between components is
left out. Pairs whose sketches (four bits of each place
of a longer signature, made for crowded documents only) differ in more places than those of any
similar pair would, by more than SURE standard deviations, are no candidates; this is decided while
a bucket is joined with itself, so that they are never written. Links are confirmed on the full
shingle sets.

Null and empty texts have no shingles and are linked with nothing. Rows with a null id are returned
with a null component, kept and linked with nothing. Rows that share an id count as one document.
An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, WordTable, arrow_map, per_worker, slices, texts
from credit_marts.llm.components import components

BANDS, BAND_ROWS = 40, 6  # a pair at a similarity of 0.8 misses all bands with probability 5e-6
SURE = 5.0  # a pair at the threshold differs in more places with a probability below 1e-6
PLANES = 4  # bits of each place in a sketch
SKETCH = 960  # places of a sketch
MOST_PLACES = 36_000_000  # places of all shingles whose orders are held at a time

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lower-cased, cut at spaces and the characters 9 to 13."""
    return text.encode().lower().split()


def shingle_set(text: str, size: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles themselves; fewer words than ``size`` make one shingle."""
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: 64 well-mixed bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def hashed_sets(lines: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles."""
    split = [words_of(t) for t in lines]
    table = per_worker("minhash", None, lambda: WordTable(_word_hashes))
    rows = table([w for words in split for w in words])
    hashes, at, found = table.values[rows], 0, []
    for words in split:
        own = hashes[at : at + len(words)]
        at += len(words)
        span = min(size, len(own))
        joined = np.full(max(0, len(own) - span + 1) if span else 0, span, dtype=np.uint64)
        for i in range(span):
            joined = mixed(joined * _GOLDEN + own[i : len(own) - span + 1 + i])
        found.append(np.unique(joined))
    return found


def super_minhash(sets: list[np.ndarray], places: int) -> np.ndarray:
    """Signatures, one row per set; two sets agree in a place if the same shingle won it."""
    out = np.full((len(sets), places), np.iinfo(np.uint64).max, dtype=np.uint64)
    most = max(1, MOST_PLACES // places)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // most
    for g in np.unique(group):
        own = np.flatnonzero((group == g) & (sizes > 0))
        if len(own) == 1 and sizes[own[0]] > most:  # a very long text: bids of its parts, lowest ones kept
            whole = sets[own[0]]
            for i in range(0, len(whole), most):
                part = _bids([whole[i : i + most]], places)
                out[own[0]] = np.minimum(out[own[0]], part[0])
        elif len(own):
            out[own] = _bids([sets[i] for i in own], places)
    return out


def _bids(sets: list[np.ndarray], places: int) -> np.ndarray:
    shingles = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    best = np.full(len(sets) * places, np.iinfo(np.uint64).max, dtype=np.uint64)
    order = np.broadcast_to(np.arange(places, dtype=np.uint16), (len(shingles), places)).copy()
    for rank in range(places):
        bits = mixed(shingles + np.uint64((rank + 1) * int(_GOLDEN) % 2**64))
        chosen = (rank + (((bits & np.uint64(0xFFFFFFFF)) * np.uint64(places - rank)) >> np.uint64(32))).astype(np.int64)
        row = np.arange(len(shingles))
        place = order[row, chosen]
        order[row, chosen] = order[:, rank]
        np.minimum.at(best, doc * places + place, np.uint64(rank << 32) | (bits >> np.uint64(32)))
        open_docs = best.reshape(-1, places).max(axis=1) >= np.uint64((rank + 1) << 32)
        if not open_docs.any():
            break
        stay = open_docs[doc]
        if not stay.all():
            shingles, doc, order = shingles[stay], doc[stay], order[stay]
    return best.reshape(-1, places)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands)).copy()
    split = signatures.reshape(len(signatures), bands, rows)
    for i in range(rows):
        keys = mixed(keys * _GOLDEN + split[:, :, i])
    return keys.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """PLANES bits of every place, as rows of 64-bit words: all first bits, then all second bits, ..."""
    bits = mixed(signatures)
    planes = []
    for shift in range(PLANES):
        packed = np.packbits(((bits >> np.uint64(shift)) & np.uint64(1)).astype(np.uint8), axis=1)
        planes.append(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.int64))
    return np.concatenate(planes, axis=1)


def most_differences(places: int, percent: int) -> int:
    """In how many places the sketches of a pair at the threshold may differ."""
    share = (1 - 0.5**PLANES) * (1 - percent / 100)
    return int(places * share + SURE * (places * share * (1 - share)) ** 0.5)


def may_be_close(places: int, percent: int, n_a: str, n_b: str, a: str, b: str) -> str:
    """SQL: whether sizes and sketches (named by column) allow a pair to be similar enough."""
    words = -(-places // 64)
    any_bit = (
        " | ".join(f"({a}[{i + words * plane}] ^ {b}[{i + words * plane}])" for plane in range(PLANES)) for i in range(words)
    )
    differ = " + ".join(f"bit_count({bits})" for bits in any_bit)
    sizes = f"100 * least({n_a}, {n_b}) >= {percent} * greatest({n_a}, {n_b})"
    return f"{sizes} AND {differ} <= {most_differences(places, percent)}"


def features(docs: DataFrame, size: int, bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """(id, n_shingles, set_key, bands) of the output of ``texts``. Narrow: no exchange."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in slices(batch):
                sets = hashed_sets(part["text"].to_pylist(), size)
                keys = band_keys(super_minhash(sets, bands * rows), bands, rows)
                keys = [k if len(s) else k[:0] for k, s in zip(keys, sets, strict=True)]
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate(keys) if keys else np.array([], np.int64))
                digest = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                columns = [part["id"], pa.array(map(len, sets), pa.int64()), pa.array(digest, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "set_key", "bands"])

    return arrow_map(docs, batches, "id bigint, n_shingles bigint, set_key binary, bands array<bigint>")


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(id, text, n, sketch) of the output of ``texts``. Narrow: no exchange."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in slices(batch):
                sets = hashed_sets(part["text"].to_pylist(), size)
                sketch = sketches(super_minhash(sets, SKETCH))
                ends = np.arange(len(sets) + 1, dtype=np.int32) * sketch.shape[1]
                words = pa.ListArray.from_arrays(ends, np.ascontiguousarray(sketch).ravel())
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["text"], pa.array(map(len, sets), pa.int64()), words], ["id", "text", "n", "sketch"]
                )

    return arrow_map(docs, batches, "id bigint, text string, n bigint, sketch array<bigint>")


def verified(pairs: DataFrame, kept: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough. ``kept`` has each id once."""
    sides = pairs.join(kept.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    sides = sides.join(kept.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, set())
        for batch in found:
            good = []
            for a, text_a, text_b in zip(
                batch["a"].to_pylist(), batch["text_a"].to_pylist(), batch["text_b"].to_pylist(), strict=True
            ):
                if last[0] != a:
                    last = (a, shingle_set(text_a, size))
                other = shingle_set(text_b, size)
                shared = len(last[1] & other)
                good.append(100 * shared >= percent * (len(last[1]) + len(other) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch[c].filter(pa.array(good, pa.bool_())) for c in ("a", "b")], ["a", "b"]
            )

    return arrow_map(sides.select("a", "b", "text_a", "text_b"), batches, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row: the smallest id reachable by links of
    documents with ``100 * intersection >= percent * union`` shingles."""
    steps = Steps(docs.sparkSession)
    lines = texts(docs, id_col, text_col)
    found = steps.store(features(lines, size, bands, rows))
    real = found.where("id IS NOT NULL AND n_shingles > 0")
    classes = steps.store(
        real.groupBy("set_key").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    )
    # Several classes may share the smallest id where rows share an id: they are one document.
    banded = classes.select(F.explode("bands").alias("key"), F.col("rep").alias("id"))
    counted = banded.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("members"))
    leaders = steps.store(counted.where("members > 1").drop("members"))
    crowded = steps.store(banded.join(leaders, "key"))  # buckets with at least two classes
    ids = steps.store(crowded.select("id").distinct())
    kept = steps.store(sketched(lines.join(ids, "id", "left_semi").dropDuplicates(["id"]), size), codec="zstd")
    about = kept.select("id", "n", "sketch")
    close = may_be_close(SKETCH, percent, "n_a", "n_b", "sketch_a", "sketch_b")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    first = crowded.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    first = first.join(side(about, "a"), "a").join(side(about, "b"), "b").where(close).select("a", "b")
    first = steps.store(first)
    links = steps.store(verified(first, kept, size, percent))
    united = components(links, steps)

    labelled = crowded.select("key", "id").join(united.select(F.col("node").alias("id"), "component"), "id", "left")
    labelled = steps.store(labelled.withColumn("component", F.coalesce("component", "id")))
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed_up = labelled.join(open_keys.where("low <> high").select("key"), "key", "left_semi")
    keys = crowded.groupBy("id").agg(F.collect_set("key").alias("keys"))  # as many as there are bands
    mixed_up = steps.store(mixed_up.join(about, "id").join(keys, "id"))
    left, right = (
        mixed_up.select("key", *[F.col(c).alias(n) for c, n in (
            ("id", s), ("n", f"n_{s}"), ("sketch", f"sketch_{s}"), ("component", f"component_{s}"), ("keys", f"keys_{s}"))]) for s in "ab"
    )
    # A pair that shares several buckets is looked at in the one with the smallest key.
    once = "array_min(array_intersect(keys_a, keys_b)) = key"
    second = left.join(right, "key").where(f"component_a <> component_b AND a < b AND {close} AND {once}")
    second = second.select("a", "b").distinct()
    second = steps.store(second.join(first, ["a", "b"], "left_anti"))
    more = steps.store(verified(second, kept, size, percent))
    united = components(links.unionAll(more), steps) if more.take(1) else united

    named = classes.select("set_key", "rep").join(united.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = steps.store(named.select("set_key", F.coalesce("component", "rep").alias("component")))
    rest = found.where("id IS NULL OR n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    whole = real.join(named, "set_key").select("id", "n_shingles", F.col("component").alias("component_id"))
    return whole.unionAll(rest).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
