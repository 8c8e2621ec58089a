"""Spelling variants: words that differ by one character, found among sorted rotations.

A word w marked by a terminator is rotated at each of its characters. With w = x c y, the rotation
that ends in c is y$x c. All words that have another character there share the prefix y$x, and the
word without the character, xy, has y$x itself as a rotation. So the rotations that share a prefix
skipping one character lie together when sorted, and a scan over the groups finds every replacement,
insertion and deletion. A replaced pair shares one prefix. A deleted pair shares one for every
equal character in a row; only the last of those is counted. A group has at most one word for each
character of the alphabet, and one without it, so no group is large.

The scan emits one row per word of a group, not its pairs: how many near words it adds and the
strongest of them. Words are numbered in code-point order first, so that rows carry numbers and ties
are settled by them. Prefixes of over LONG characters are replaced by a digest of 127 bits, worked
out from prefix sums, so that a word's rotations take room in proportion to its length.

A word's form is the near word with most occurrences (ties: the first in code-point order), if it
has at least twice as many. Forms are followed to the root by doubling steps.

Null and empty texts have no words; a null id drops no character. Very long texts and runs are
whole like all others. Repeated rows count each. An empty table gives an empty table. Columns other
than id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, arrow_map, ranges, slices

MODULUS = 97  # a run loses a character where its hash is divisible by this
LEAST_CHARS, LEAST_COUNT = 5, 3
STRONGER = 2  # a form occurs at least so many times as often
LONG = 64  # characters of a prefix that is kept as it is
MOST_KEPT = 400_000  # distinct words a task adds up before it sends them

_LOWER = bytes(byte + 32 if 0x41 <= byte <= 0x5A else byte for byte in range(256))
_RUN = re.compile("[a-zÀ-ÿ]+")
_END = "$"

# Of the digests: a prime, and a base below it.
_PRIME, _BASE = (1 << 127) - 1, 0x1F3D5B79A2C4E6081234567

BASE, LAST, INNER = 0, 1, 2  # without the character; with it, at the end of its row of equal ones or not


def runs(text: str) -> list[str]:
    """The runs of letters of a text, A-Z in lower case."""
    return _RUN.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"))


def doc_words(key: int | None, text: str) -> Counter:
    """Occurrences of a document's words, after the characters its id drops."""
    counts = Counter(runs(text))
    if key is not None:
        before, crc = zlib.crc32(f"{key}:".encode()), zlib.crc32
        hashes = [(run, crc(run.encode(), before)) for run in counts]
        hit = [(run, h % len(run), counts.pop(run)) for run, h in hashes if h % MODULUS == 0]
        for run, at, n in hit:
            counts[run[:at] + run[at + 1 :]] += n
    return counts


def _counted(least_chars: int):
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def sent() -> pa.RecordBatch:
            long = [(word, n) for word, n in sums.items() if len(word) >= least_chars]
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in long], pa.string()), pa.array([n for _, n in long], pa.int64())], ["word", "n"]
            )

        for batch in found:
            for part in slices(batch):
                for key, text in zip(part["id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    sums.update(doc_words(key, text))
                if len(sums) > MOST_KEPT:
                    yield sent()
                    sums.clear()
        yield sent()

    return batches


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = arrow_map(rows, _counted(least_chars), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def numbered(words: DataFrame, steps: Steps) -> DataFrame:
    """(id, word, n) with ids from 0 in code-point order. Words are distinct."""
    words = steps.store(words)
    total = words.count()

    def places(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in found:
            place = np.arange(before, before + len(batch), dtype=np.int64)
            before += len(batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(batch), part, np.int32)), pa.array(place)],
                ["word", "n", "part", "place"],
            )

    spread = words.select("word", "n").repartitionByRange(ranges(words.sparkSession, total), "word").sortWithinPartitions("word")
    placed = steps.store(arrow_map(spread, places, "word string, n bigint, part int, place bigint"))
    begins, before = [], 0
    for r in placed.groupBy("part").count().orderBy("part").collect():  # one row per range
        begins.append((r["part"], before))
        before += r["count"]
    starts = F.broadcast(words.sparkSession.createDataFrame(begins, "part int, begin bigint"))
    return placed.join(starts, "part").select((F.col("begin") + F.col("place")).alias("id"), "word", "n")


def skipping_prefixes(word: str) -> Iterator[tuple[str, int]]:
    """The prefix of every rotation that ends before a character, and of the rotations themselves,
    with their kinds."""
    size, marked = len(word), word + _END
    if size >= LONG:
        yield from _digests(word)
    else:
        for i in range(size + 1):
            yield marked[i:] + word[:i], BASE
    if size <= LONG:
        for i in range(size):
            yield marked[i + 1 :] + word[:i], LAST if marked[i + 1] != word[i] else INNER


def _digests(word: str) -> Iterator[tuple[str, int]]:
    """As ``skipping_prefixes``, for prefixes of over LONG characters."""
    size, sums, powers = len(word), [0], [1]
    for c in word:
        sums.append((sums[-1] * _BASE + ord(c)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)

    def rotated(begin: int, stop: int) -> str:
        tail = (sums[size] - sums[begin] * powers[size - begin]) % _PRIME
        return f"{(((tail * _BASE + ord(_END)) * powers[stop]) + sums[stop]) % _PRIME:032x}"

    for i in range(size + 1):
        yield rotated(i, i), BASE
    if size > LONG:
        for i in range(size):
            yield rotated(i + 1, i), LAST if i + 1 == size or word[i + 1] != word[i] else INNER


def _rotated(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(prefixes, pa.string()), pa.array(kinds, pa.int8()), pa.array(ids, pa.int64()), pa.array(counts, pa.int64())],
            ["prefix", "kind", "id", "n"],
        )

    prefixes, kinds, ids, counts = [], [], [], []
    for batch in found:
        for key, word, n in zip(batch["id"].to_pylist(), batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
            for prefix, kind in skipping_prefixes(word):
                prefixes.append(prefix)
                kinds.append(kind)
                ids.append(key)
                counts.append(n)
                if len(prefixes) == 100_000:
                    yield sent()
                    prefixes, kinds, ids, counts = [], [], [], []
    yield sent()


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, kind, id, n) for every rotation of every word, unsorted."""
    return arrow_map(words.select("id", "word", "n"), _rotated, "prefix string, kind tinyint, id bigint, n bigint")


def _links(group: np.ndarray, kind: np.ndarray, ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """What every word of a group gains there; ``group`` does not fall."""
    order = np.lexsort((ids, -n, group))  # the strongest first
    group, kind, ids, n = group[order], kind[order], ids[order], n[order]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    own = np.repeat(np.arange(len(first)), np.diff([*first, len(group)]))
    place = np.arange(len(group))
    far = len(group)  # the place of nothing

    def strongest(chosen: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(np.where(chosen, place, far), first)

    has, last, base = kind != BASE, kind == LAST, kind == BASE
    top, top_last, without = strongest(has), strongest(last), strongest(base)
    second = strongest(has & (place != top[own]))
    members, lasts = np.add.reduceat(has, first, dtype=np.int64), np.add.reduceat(last, first, dtype=np.int64)
    other = np.where(place == top[own], second[own], top[own])  # for words with a character there
    other = np.where(last, np.minimum(other, without[own]), other)
    best = np.where(base, top_last[own], other)
    near = np.where(base, lasts[own], members[own] - 1 + (last & (without[own] < far)))
    found = near > 0
    best = best[found]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[found]), pa.array(near[found]), pa.array(n[best]), pa.array(ids[best])], ["id", "n_near", "best_n", "best"]
    )


def _scanned(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal prefixes among sorted rows; the last group of a batch waits for the next."""
    held = None
    for batch in found:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if len(batch) < 2:
            held = batch
            continue
        prefix = batch["prefix"]
        new = np.concatenate([[True], pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)])
        last = int(np.flatnonzero(new)[-1])
        held = batch.slice(last)
        yield from _of(batch.slice(0, last), new[:last])
    if held is not None and len(held) > 1:  # one group
        yield from _of(held, np.arange(len(held)) == 0)


def _of(batch: pa.RecordBatch, new: np.ndarray) -> Iterator[pa.RecordBatch]:
    group = np.cumsum(new)
    chosen = np.bincount(group)[group] > 1 if len(group) else group
    if chosen.any():
        columns = (batch[c].to_numpy()[chosen] for c in ("kind", "id", "n"))
        yield _links(group[chosen], *columns)


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best) for numbered words with near ones: how many, and the strongest."""
    found = rotations(words)
    per_word = 2 * LEAST_CHARS + 1  # rotations of the shortest
    parts = ranges(words.sparkSession, per_word * words.count())
    spread = found.repartitionByRange(parts, "prefix").sortWithinPartitions("prefix")
    links = arrow_map(spread, _scanned, "id bigint, n_near bigint, best_n bigint, best bigint")
    best = F.max(F.struct("best_n", (-F.col("best")).alias("first")))
    found = links.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.first")).alias("best"))


def roots(forms: DataFrame, steps: Steps) -> DataFrame:
    """(id, root) from (id, form): the end of the chain that starts at each id. Chains have no rings."""
    paths = steps.store(forms.select("id", F.col("form").alias("root")))
    while True:
        onward = paths.select(F.col("id").alias("root"), F.col("root").alias("onward"))
        paths = paths.join(onward, "root", "left").select(
            "id", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")
        )
        paths = steps.store(paths)
        moved = paths.where("moved").limit(1).count()
        paths = paths.select("id", "root")
        if not moved:
            return paths


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT, stronger: int = STRONGER,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word that is long and frequent enough."""
    steps = Steps(docs.sparkSession)
    words = steps.store(numbered(word_counts(docs, id_col, text_col, least_chars, least_count), steps))
    near = steps.store(neighbours(words))
    words = words.join(near, "id", "left").withColumn("form", F.expr(f"CASE WHEN best_n >= {stronger} * n THEN best END"))
    words = steps.store(words)
    ends = roots(words.where("form IS NOT NULL"), steps)
    names = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    tops = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    linked = words.where("form IS NOT NULL").join(ends, "id").join(names, "form").join(tops, "root")
    linked = linked.select("id", "form_word", "root_word")
    whole = words.join(linked, "id", "left")
    return whole.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("form_word").alias("form"),
        F.when(F.col("form_word").isNotNull(), F.col("best_n")).alias("form_n"),
        F.coalesce("root_word", "word").alias("root"),
    )
