"""Language ID: one Bloom filter for all languages, sliced by bits, answers with language masks.

Every slot of the filter holds one bit per language. An n-gram sets its languages' bits in a few
slots; the bits that all its slots share are the languages that contain it, with some false ones.
A text's n-grams are counted per language, the expected false ones are taken off, and the language
with most n-grams left is chosen.

A language contains an n-gram if it is not much rarer there than in the language that uses it most.
Counts come from a bounded sample of documents per language, by hash of the id; every n-gram of the
sample is put in, however rare. Rates are worked out and slots joined in Spark, so the driver holds
the filter and no list of n-grams. The filter has more slots the more n-grams a language has, up to
MOST_BYTES; beyond that the false ones become more, and are taken off as before.

The text alone is looked at. Null texts and those without a letter are ``und`` with score 0, and so
is everything when no labelled row is there to learn from. Ties go to the language that sorts first.
Repeated rows are predicted each on its own. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, WordTable, arrow_map, crc_bucket, hashed_share, per_worker, sample_share, slices, texts
from credit_marts.llm.minhash import mixed

FIT_ROWS = 3_000  # documents per language that n-grams are counted in
MOST_BYTES = 1 << 25  # size of the filter, unless its least slots already need more
FOLDS, HELD_OUT = 3, 1
GRAMS = (1, 2, 3, 4)
LEAST_BITS, HASHES = 20, 3  # at least 2 ** LEAST_BITS slots
BLOCK = 4096  # slots that come to the driver as one value
ROOM = 8  # slots for each n-gram of the language with most
RARER = 0.2  # an n-gram belongs to a language with at least this share of its highest rate

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def gram_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words between marks, and the number of the word of each."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    marks = codes == 32
    word = np.cumsum(marks) - 1  # a mark belongs to the word after it
    hashes, owners = [], []
    for n in GRAMS:
        if len(codes) < n:
            continue
        joined = np.full(len(codes) - n + 1, n, dtype=np.uint64)
        inner = np.zeros(len(joined), dtype=bool)
        for i in range(n):
            joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i])
            if 0 < i < n - 1 or n == 1:
                inner |= marks[i : len(codes) - n + 1 + i]
        if n == 2:
            inner |= marks[: len(joined)] & marks[1 : len(joined) + 1]
        hashes.append(joined[~inner])
        owners.append(word[: len(joined)][~inner])
    return np.concatenate(hashes), np.concatenate(owners)


def slots_of(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The slots of each hash, of 2 ** ``bits``."""
    start, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return [((start + np.uint64(i) * step) & np.uint64((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


def slot_bits(languages: int, grams: int) -> int:
    """Of a filter of so many languages, of which none has more than ``grams`` n-grams."""
    most = (MOST_BYTES // (-(-languages // 8) or 1)).bit_length() - 1
    return max(LEAST_BITS, min((ROOM * grams).bit_length(), most))


@dataclass
class Filter:
    """Slots of language masks; eight languages to a byte of a mask."""

    languages: list[str]
    slots: np.ndarray

    @classmethod
    def of(cls, languages: list[str], hashes: np.ndarray, owner: np.ndarray) -> Filter:
        """``owner`` is the number of the language that contains the n-gram beside it."""
        bits = slot_bits(len(languages), int(np.bincount(owner).max(initial=0)))
        masks = cls.empty(languages, bits)
        for places in slots_of(hashes, bits):
            np.bitwise_or.at(masks.slots, (places, owner // 8), (1 << (owner % 8)).astype(np.uint8))
        return masks

    @classmethod
    def empty(cls, languages: list[str], bits: int) -> Filter:
        return cls(languages, np.zeros((1 << bits, -(-len(languages) // 8) or 1), dtype=np.uint8))

    @property
    def bits(self) -> int:
        return len(self.slots).bit_length() - 1

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """One row per n-gram, one column per language: whether it may be contained."""
        masks = np.bitwise_and.reduce([self.slots[p] for p in slots_of(hashes, self.bits)])
        return np.unpackbits(masks, axis=1, bitorder="little")[:, : len(self.languages)]

    def false_rates(self) -> np.ndarray:
        bits = [np.unpackbits(self.slots[i : i + 65536], axis=1, bitorder="little").sum(0, dtype=np.int64)
                for i in range(0, len(self.slots), 65536)]
        return (np.sum(bits, axis=0)[: len(self.languages)] / len(self.slots)) ** HASHES

    def word_counts(self, words: list[str]) -> np.ndarray:
        """Per word: its n-grams in each language, and in all."""
        out = np.zeros((len(words), len(self.languages) + 1), dtype=np.float32)
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            hashes, owner = gram_hashes(part)
            found = self.has(hashes)
            for language in range(len(self.languages)):
                out[at : at + len(part), language] = np.bincount(owner, found[:, language], len(part))[: len(part)]
            out[at : at + len(part), -1] = np.bincount(owner, minlength=len(part))[: len(part)]
        return out

    def predict(self, lines: list[str], table: WordTable, false: np.ndarray) -> tuple[list[str], np.ndarray]:
        split = [words_of(t) for t in lines]
        counts = np.array([len(w) for w in split])
        rows = table([w for own in split for w in own])
        owner = np.repeat(np.arange(len(split)), counts)
        sums = np.stack([np.bincount(owner, table.values[rows, c], len(split)) for c in range(table.values.shape[1])], axis=1)
        real = np.maximum(0, (sums[:, :-1] - sums[:, -1:] * false) / np.maximum(1 - false, 1e-9))
        best = real.argmax(1)
        top = real[np.arange(len(split)), best]
        score = np.where(counts > 0, top / np.maximum(real.sum(1), 1e-9), 0.0)
        return [self.languages[b] if c else "und" for b, c in zip(best, counts, strict=True)], np.clip(score, 0, 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            by: dict[str, list[str]] = {}
            for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist(), strict=True):
                by.setdefault(lang, []).extend(words_of(text))
            for lang, words in by.items():
                if words:
                    hashes, counts = np.unique(gram_hashes(words)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(hashes)), pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))],
                        ["lang", "gram", "n"],
                    )


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = FIT_ROWS) -> Filter:
    """The filter of a sample of about ``rows`` documents per language outside of the held-out fold."""
    known = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    known = known.where(crc_bucket("id", FOLDS) != HELD_OUT)
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = F.lit(False)
    for lang, size in sizes.items():
        chosen = chosen | ((F.col("lang") == lang) & hashed_share("id", sample_share(size, rows)))
    grams = arrow_map(known.where(chosen).select("lang", "text"), _counted, "lang string, gram bigint, n bigint")
    grams = Steps(docs.sparkSession).store(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    languages = sorted(sizes)
    number = {lang: i for i, lang in enumerate(languages)}
    found = grams.groupBy("lang").agg(F.sum("n").alias("total")).collect()  # one row per language
    totals = docs.sparkSession.createDataFrame(
        [(r["lang"], number[r["lang"]], r["total"]) for r in found], "lang string, number int, total bigint"
    )
    rates = grams.join(F.broadcast(totals), "lang").select("gram", "number", (F.col("n") / F.col("total")).alias("rate"))
    own = rates.groupBy("gram").agg(F.max("rate").alias("most"), F.collect_list(F.struct("number", "rate")).alias("by"))
    own = own.select("gram", "most", F.explode("by").alias("own")).where(F.col("own.rate") >= RARER * F.col("most"))
    own = Steps(docs.sparkSession).store(own.select("gram", F.col("own.number").alias("number")))
    counts = [r["count"] for r in own.groupBy("number").count().collect()]
    masks = Filter.empty(languages, slot_bits(len(languages), max(counts, default=0)))
    slots = arrow_map(own, _placed(masks.bits), "slot bigint, byte int, mask int")
    slots = slots.groupBy("slot", "byte").agg(F.bit_or("mask").alias("mask"))
    # Blocks of the filter as strings of bytes: the driver gets the filter and nothing beside it.
    size = masks.slots.shape[1]
    cell = ((F.col("slot") % BLOCK) * size + F.col("byte")).cast("int")
    blocks = slots.groupBy(F.floor(F.col("slot") / BLOCK).alias("block")).agg(
        F.collect_list(F.struct(cell.alias("cell"), F.col("mask").cast("tinyint").alias("mask"))).alias("cells")
    )
    packed = arrow_map(blocks, _packed(BLOCK * size), "block bigint, cells binary").toArrow()
    for block, cells in zip(packed["block"].to_pylist(), packed["cells"], strict=True):
        masks.slots[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(cells.as_buffer(), np.uint8).reshape(BLOCK, size)
    return masks


def _packed(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of the filter, all their bytes in order."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            blocks = []
            for cells in batch["cells"]:
                whole = np.zeros(size, np.uint8)
                whole[cells.values.field("cell").to_numpy()] = cells.values.field("mask").to_numpy().view(np.uint8)
                blocks.append(whole.tobytes())
            yield pa.RecordBatch.from_arrays([batch["block"], pa.array(blocks, pa.binary())], ["block", "cells"])

    return batches


def _placed(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            owner = batch["number"].to_numpy()
            byte, mask = pa.array(owner // 8, pa.int32()), pa.array(1 << (owner % 8), pa.int32())
            for places in slots_of(batch["gram"].to_numpy().view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array(places), byte, mask], ["slot", "byte", "mask"])

    return batches


def _table(masks: Filter) -> tuple[WordTable, np.ndarray]:
    """The counts per word and the false rates of a filter, one per worker and filter."""
    name = (*masks.languages, int(masks.slots.sum(dtype=np.int64)))
    return per_worker("lang_masks", name, lambda: (WordTable(masks.word_counts), masks.false_rates()))


def predicted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score) for every row. A null id counts as learned from."""
    masks = fit(docs, id_col, text_col, lang_col)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in slices(batch):
                if masks.languages:
                    lang, score = masks.predict(part["text"].to_pylist(), *_table(masks))
                else:
                    lang, score = ["und"] * len(part), np.zeros(len(part))
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(lang, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    found = arrow_map(texts(docs, id_col, text_col), batches, "id bigint, lang_pred string, score double")
    held = F.coalesce(crc_bucket("id", FOLDS) == HELD_OUT, F.lit(False))
    return found.select("id", held.alias("held_out"), "lang_pred", "score")
