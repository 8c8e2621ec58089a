"""Importance resampling towards a target distribution, by hashed n-grams of words.

A text is lower-cased (A-Z only) and everything between words becomes a single space. A regular
expression then runs over it with overlapping matches: boundaries on both sides make every match
start and end with whole words, so the spans of one size are its n-grams, found in place. The crc32
of a span's bytes, modulo the number of buckets, is its feature.

Every text is scanned once. What is stored is its distinct buckets with their counts; totals per
bucket are added up inside tasks first, and only the gains (one number per bucket) go to the tasks
that weigh documents. Rows are drawn by weight plus Gumbel noise, which depends on the id alone, so
the draw is the same on every run. Ranks come from a range sort over all rows and the number of
eligible rows in each range.

Null and empty texts have no words, weight 0, a score, and no rank. A null id counts as an empty
string in the noise and sorts last among ties. Repeated rows are drawn each on its own. Very long
texts are whole like all others. An empty table gives an empty table; an empty target makes every
gain follow the source alone. Other columns are not read by ``resampled``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, arrow_map, ranges, slices

BUCKETS = 10_000
SIZES = (1, 1)  # fewest and most words of a feature
PERCENT = 10  # of the eligible documents
LEAST_WORDS = 20  # of an eligible document
SEED = 2024

# Lower case for A-Z, a space for what is no part of a word. Bytes of other alphabets stay.
_PLAIN = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte > 0x7F else 0x20
    for byte in range(256)
)
_GAPS = re.compile(rb" {2,}")


def collapsed(data: bytes) -> bytes:
    """The words of a UTF-8 text with single spaces between them."""
    return _GAPS.sub(b" ", data.translate(_PLAIN)).strip(b" ")


def gram_pattern(size: int) -> regex.Pattern:
    """Matches ``size`` whole words of a collapsed text."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (size - 1))


def gram_spans(data: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Where the n-grams of a collapsed text begin and end."""
    return (match.span() for match in gram_pattern(size).finditer(data, overlapped=True))


def features(data: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every n-gram of a collapsed text, repeats included."""
    crc = zlib.crc32
    found = [
        np.fromiter((crc(match[0]) for match in pattern.finditer(data, overlapped=True)), np.uint32)
        for pattern in patterns
    ]
    return (np.concatenate(found) % buckets).astype(np.int64)


_HASHED = "row bigint, n_words bigint, n_features bigint, buckets array<int>, counts array<int>"


def _scan(sizes: tuple[int, int], buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [gram_pattern(size) for size in range(sizes[0], sizes[1] + 1)]
        for batch in found:
            for part in slices(batch, "data"):
                words, sums, own, counts, ends = [], [], [], [], [0]
                for data in part["data"].to_pylist():
                    text = collapsed(data)
                    bucket, n = np.unique(features(text, patterns, buckets), return_counts=True)
                    words.append(text.count(b" ") + 1 if text else 0)
                    sums.append(int(n.sum()))
                    own.append(bucket)
                    counts.append(n)
                    ends.append(ends[-1] + len(bucket))
                at = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part["row"], pa.array(words, pa.int64()), pa.array(sums, pa.int64())]
                    + [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x), pa.int32())) for x in (own, counts)]
                    + [part[name] for name in part.schema.names if name not in ("row", "data")],
                    ["row", "n_words", "n_features", "buckets", "counts"]
                    + [name for name in part.schema.names if name not in ("row", "data")],
                )

    return batches


def hashed(
    df: DataFrame, text_col: str = "text", sizes: tuple[int, int] = SIZES, buckets: int = BUCKETS, **keep
) -> DataFrame:
    """Every row's words, features, distinct buckets and their counts, beside the columns in ``keep``.

    ``row`` numbers the rows within one evaluation; store the result before using it twice.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), data.alias("data"), *(c.alias(n) for n, c in keep.items())
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join([_HASHED, *(f"`{name}` {kinds[name]}" for name in keep)])
    return arrow_map(rows, _scan(sizes, buckets), schema)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row in the batch, bucket and count of every entry."""
    owner = np.repeat(np.arange(len(batch)), batch["buckets"].value_lengths().to_numpy(zero_copy_only=False))
    return owner, batch["buckets"].flatten().to_numpy(), batch["counts"].flatten().to_numpy().astype(np.int64)


def bucket_totals(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows. Tasks send one row per bucket at most."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in found:
            _, bucket, n = _lists(batch)
            np.add.at(sums, bucket, n)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used])], ["bucket", "n"])

    parts = arrow_map(rows.select("buckets", "counts"), batches, "bucket int, n bigint")
    totals = np.zeros(buckets, dtype=np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        totals[r["bucket"]] = r["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier a bucket is in the target, rounded down."""
    buckets = len(source)
    likelier = (target + 1.0) * (source.sum() + float(buckets)) / ((source + 1.0) * (target.sum() + float(buckets)))
    return np.floor(1000.0 * np.log(likelier)).astype(np.int64)


def _weighed(rows: DataFrame, gain: np.ndarray, keep: list[str]) -> DataFrame:
    """The sum of the gains of every row's features."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            owner, bucket, n = _lists(batch)
            sums = np.zeros(len(batch), dtype=np.int64)
            np.add.at(sums, owner, gain[bucket] * n)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(sums)], [*kept, "weight"])

    kept = ["row", "n_words", "n_features", *keep]
    kinds = dict(rows.dtypes)
    return arrow_map(
        rows.select(*kept, "buckets", "counts"), batches, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", weight bigint"
    )


def noise(id_col: str = "id", seed: int = SEED):
    """Thousandths of Gumbel noise by the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(drawn))).cast("bigint")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of the range and of the eligible row in it, for sorted rows."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        eligible = batch["eligible"].to_numpy(zero_copy_only=False)
        place = before + np.cumsum(eligible)
        before += int(eligible.sum())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(batch), part, np.int32)), pa.array(place.astype(np.int64))],
            [*batch.schema.names, "part", "place"],
        )


def ranked(rows: DataFrame, steps: Steps, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Weighed rows with ``rank``: 1, 2, 3... for the highest ``percent`` scores of the eligible ones,
    ties to the smaller id."""
    rows = rows.withColumn("eligible", F.col("n_words") >= least_words)
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    total = rows.count()
    spread = rows.repartitionByRange(ranges(rows.sparkSession, total), *order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in spread.dtypes) + ", part int, place bigint"
    placed = steps.store(arrow_map(spread, _placed, schema))
    sizes = placed.groupBy("part").agg(F.sum(F.col("eligible").cast("bigint")).alias("n")).orderBy("part").collect()
    begins, eligible = [], 0
    for r in sizes:  # one row per range
        begins.append((r["part"], eligible))
        eligible += r["n"]
    starts = F.broadcast(rows.sparkSession.createDataFrame(begins, "part int, begin bigint"))
    rank = F.col("begin") + F.col("place")
    drawn = F.col("eligible") & (rank <= percent * eligible // 100)
    return placed.join(starts, "part").withColumn("rank", F.when(drawn, rank))


def _resampled(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, target_col: str, keep: dict, **options) -> DataFrame:
    steps = Steps(docs.sparkSession)
    sizes, buckets = options.get("sizes", SIZES), options.get("buckets", BUCKETS)
    rows = steps.store(hashed(docs, text_col, sizes, buckets, id=F.col(id_col).cast("bigint"), **keep), codec="zstd")
    wanted = hashed(target, target_col, sizes, buckets)
    gain = gains(bucket_totals(rows, buckets), bucket_totals(wanted, buckets))
    weighed = _weighed(rows, gain, ["id", *keep]).withColumn("score", F.col("weight") + noise("id", options.get("seed", SEED)))
    return ranked(steps.store(weighed), steps, options.get("percent", PERCENT), options.get("least_words", LEAST_WORDS))


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", **options
) -> DataFrame:
    """(id, n_features, weight, score, rank) for every row of ``docs``; rank is null where not drawn.

    Options: ``sizes``, ``buckets``, ``percent``, ``least_words``, ``seed``.
    """
    found = _resampled(docs, target, id_col, text_col, target_col, {}, **options)
    return found.select("id", "n_features", "weight", "score", "rank")


def drawn(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their own columns only."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    found = _resampled(docs, target, id_col, text_col, target_col, {"whole": whole}, **options)
    return found.where("rank IS NOT NULL").select("whole.*")
