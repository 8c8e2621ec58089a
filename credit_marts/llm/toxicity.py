"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of itself and its character n-grams, a document the mean of its
words, so a misspelling no one has seen shares most of its vectors with the word it stems from. The
model is fitted on a bounded sample of labelled documents: the first dimension of an n-gram starts
at the cube of its smoothed log-odds, the softmax is fitted on that, and then embeddings and softmax
move together down the gradient until the loss of a part of the sample, which is held back from all
of this, stops falling. As the log-odds of an n-gram count the document they are used on, each
document that is learned from takes its own part off them. Every word of two documents takes part.

As all is linear behind the embeddings, a word adds one number to a document's score; it is worked
out once per worker and word. Null and empty texts score as the mean of no words. Without labelled
rows of both kinds every score is 0. Labels that repeat or differ for an id count as their maximum;
null labels and ids are not learned from. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import (
    Steps, WordTable, arrow_map, crc_bucket, hashed_share, per_worker, sample_share, ship, slices, texts,
)

FIT_ROWS = 8_000  # labelled documents the model is fitted on, a third of them toxic at most
FOLDS = 5  # documents of fold 0 are not learned from
DIMS = 4
SPREAD = 100.0  # what the mean of a document is multiplied by
BLANKS = 12  # words without weight that every document has besides its own: few words prove little
GRAMS = (4, 5, 6)
PRIOR = 15  # documents of the usual mixture that every n-gram counts as seen in besides its own
STEP = 1e-3  # of embeddings and softmax along their gradient; it halves when it leads uphill
FALL = 1e-3  # share by which the held-back loss must fall to count
PATIENCE = 5  # moves without such a fall after which training ends
LEAST = 2  # documents of the sample a word must occur in; one alone cannot be told from its label
BLOCK = 1 << 17  # words of documents that are added up at a time while training

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str) -> list[str]:
    """The word between marks and its n-grams."""
    marked = f"<{word}>"
    return [marked] + [marked[i : i + n] for n in GRAMS if n < len(marked) for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """The weight of every n-gram towards toxicity, and the softmax's bias."""

    grams: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -np.inf

    def word_weights(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        for i, word in enumerate(words):
            grams = grams_of(word)
            known = [self.grams[g] for g in grams if g in self.grams]
            if known:
                out[i] = self.weights[known].sum() / len(grams)
        return out

    def scores(self, lines: list[str], table: WordTable) -> np.ndarray:
        split = [words_of(t) for t in lines]
        counts = np.array([len(w) for w in split])
        rows = table([w for own in split for w in own])
        values = table.values[rows]
        sums = np.bincount(np.repeat(np.arange(len(split)), counts), weights=values, minlength=len(split))
        logits = SPREAD * sums / (counts + BLANKS) + self.bias
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-logits))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that end at ``ends`` (which begin with 0)."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[ends[1:]] - total[ends[:-1]]


def _weighted(values: np.ndarray, rows: np.ndarray, share: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values[rows] * share``, about BLOCK entries at a time."""
    out = np.zeros((len(ends) - 1, *values.shape[1:]))
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], BLOCK)), len(ends) - 1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = slice(ends[a], ends[b])
        out[a:b] = _sums(values[rows[own]] * share[own, None], ends[a : b + 1] - ends[a])
    return out


def _turned(columns: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of each column of a sparse matrix: (rows, ends, order of the entries)."""
    rows = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
    order = np.argsort(columns, kind="stable").astype(np.int32)
    return rows[order], np.concatenate([[0], np.cumsum(np.bincount(columns, minlength=size))]), order


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.steps, self.moments = rate, 0, {}

    def move(self, name: str, values: np.ndarray, slope: np.ndarray) -> None:
        first, second = self.moments.setdefault(name, (np.zeros_like(values), np.zeros_like(values)))
        first += 0.1 * (slope - first)
        second += 0.01 * (slope**2 - second)
        t = self.steps + 1
        values -= self.rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)


def train(
    vocabulary: list[str], codes: np.ndarray, counts: np.ndarray, doc_ends: np.ndarray, totals: np.ndarray,
    toxic: np.ndarray,
) -> Model:
    """``codes`` and ``counts`` are the distinct words of each document that are in the vocabulary, up
    to its place in ``doc_ends``; ``totals`` are all its words."""
    if not (toxic == 1).any() or not (toxic == 0).any() or not len(codes):
        return Model()
    # Words are numbered as they first occur.
    known, first = np.unique(codes, return_index=True)
    order = np.argsort(first)
    place = np.zeros(len(vocabulary), dtype=np.int32)
    place[known[order]] = np.arange(len(known))
    vocabulary = [vocabulary[i] for i in known[order].tolist()]
    column, share = place[codes], counts / np.repeat(totals + BLANKS, np.diff(doc_ends))

    grams: dict[str, int] = {}
    spelled_out = [[grams.setdefault(g, len(grams)) for g in grams_of(w)] for w in vocabulary]
    sizes = np.array([len(own) for own in spelled_out])
    gram = np.fromiter((g for own in spelled_out for g in own), np.int32, sizes.sum())
    word_ends, part = np.concatenate([[0], np.cumsum(sizes)]), np.repeat(1 / sizes, sizes)
    del spelled_out

    chance = np.random.default_rng(0)
    held = np.zeros(len(toxic), bool)
    held[chance.permutation(len(toxic))[: len(toxic) // 6]] = True
    if len(set(toxic[~held])) < 2:
        held[:] = False

    # Documents each n-gram occurs in, by class; then the cube of its smoothed log-odds.
    seen = np.zeros((2, len(grams)))
    for d in np.flatnonzero(~held):
        own = column[doc_ends[d] : doc_ends[d + 1]]
        if len(own):
            seen[int(toxic[d]), np.unique(np.concatenate([gram[word_ends[w] : word_ends[w + 1]] for w in own]))] += 1
    rows = np.array([(toxic[~held] == 0).sum(), (toxic[~held] == 1).sum()])[:, None]

    def odds(seen: np.ndarray) -> np.ndarray:
        rate = (np.maximum(seen, 0) + PRIOR * rows / rows.sum()) / rows
        return np.log(rate[1] / rate[0]) ** 3

    start = odds(seen)
    top = max(np.abs(start).max(), 1e-9)
    vectors = chance.normal(0, 0.01, (len(grams), DIMS))
    vectors[:, 0] = start / top
    softmax, bias = chance.normal(0, 0.01, (DIMS, 2)), np.zeros(2)
    softmax[0] = -1, 1

    gram_rows, gram_ends, order = _turned(gram, word_ends, len(grams))
    turned_part = part[order]
    word_rows, column_ends, order = _turned(column, doc_ends, len(vocabulary))
    turned_share = share[order]
    del order
    balance = np.where(toxic == 1, 0.5 / (toxic == 1).mean(), 0.5 / (toxic == 0).mean()) ** 0.75

    def hidden(values: np.ndarray) -> np.ndarray:
        return SPREAD * _weighted(_weighted(values, gram, part, word_ends), column, share, doc_ends)

    def gradient(slope: np.ndarray) -> np.ndarray:
        by_word = _weighted(SPREAD * slope[:, None], word_rows, turned_share, column_ends)
        return _weighted(by_word, gram_rows, turned_part, gram_ends)[:, 0]

    def slopes(logits: np.ndarray) -> tuple[np.ndarray, float, float]:
        """The slope of the loss along each logit; the loss that is learned from, and the held-back one."""
        loss = np.logaddexp(0, np.where(toxic == 1, -logits, logits)) * balance
        p = 0.5 * (1 + np.tanh(logits / 2))
        learned = float(loss[~held].mean())
        slope = (p - toxic) * balance * ~held / (~held).sum()
        return slope, learned, float(loss[held].mean()) if held.any() else learned

    # What each document's own count adds to the start of its means, none where it was not counted.
    ones = np.eye(2)[:, :, None]  # of a clean and of a toxic document
    added = hidden(np.stack([(start - odds(seen - one)) / top for one in ones], axis=1))
    own = np.where(held, 0.0, added[np.arange(len(toxic)), toxic])

    adam, means = Adam(0.05), hidden(vectors)
    means[:, 0] -= own
    for _ in range(1000):  # the softmax on the embeddings as they begin
        slope = slopes((means @ softmax + bias) @ (-1, 1))[0]
        adam.move("softmax", softmax, np.outer(means.T @ slope, (-1, 1)))
        adam.move("bias", bias, slope.sum() * np.array([-1, 1]))
        adam.steps += 1
    del means

    # Both. A document's logit is linear in each n-gram's weight, so slopes along the weights are all
    # that embeddings and softmax need of the documents.
    def scored(vectors: np.ndarray, softmax: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, float, float]:
        apart = softmax @ (-1, 1)
        return slopes(hidden((vectors @ apart)[:, None])[:, 0] - own * apart[0] + bias @ (-1, 1))

    step, now = STEP, (vectors, softmax, bias)
    slope, learned, held_back = scored(*now)
    best, lowest, since = now, held_back, 0
    while since < PATIENCE and step > STEP / 1000:
        vectors, softmax, bias = now
        down = gradient(slope)
        by_dim = vectors.T @ down
        by_dim[0] -= own @ slope
        tried = (
            vectors - step * np.outer(down, softmax @ (-1, 1)), softmax - step * np.outer(by_dim, (-1, 1)),
            bias - step * slope.sum() * np.array([-1, 1]),
        )
        found = scored(*tried)
        if found[1] > learned:
            step /= 2
            continue
        now, (slope, learned, held_back) = tried, found
        since = 0 if held_back < (1 - FALL) * lowest else since + 1
        if held_back < lowest:
            best, lowest = now, held_back
    vectors, softmax, bias = best
    return Model(grams, vectors @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
    for batch in batches:
        for part in slices(batch):
            rows = []
            for text in part["text"].to_pylist():
                bag = Counter(words_of(text))
                rows.append((bag.total(), list(bag.keys()), list(bag.values())))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["toxic"], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["id", "toxic", "total", "words", "counts"],
            )


def _coded(vocabulary: Broadcast):
    """Bags with the words' places in the vocabulary instead of the words; others are left out."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary.value, pa.string())
        for batch in found:
            words, counts = batch["words"], batch["counts"].flatten()
            at = pc.index_in(words.flatten(), value_set=known)
            keep = at.is_valid().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(batch)), pc.list_value_length(words).to_numpy())
            ends = pa.array(np.cumsum([0, *np.bincount(doc[keep], minlength=len(batch))]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, c.filter(pa.array(keep)).cast(pa.int32())) for c in (at, counts)]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in ("id", "toxic", "total")], *lists], ["id", "toxic", "total", "codes", "counts"]
            )

    return batches


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    rows: int = FIT_ROWS,
) -> Model:
    """The model of a sample of at most about ``rows`` labelled documents outside of fold 0."""
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where("id IS NOT NULL AND toxic IN (0, 1)").where(crc_bucket("id", FOLDS) != 0)
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = min(sizes.get(1, 0), rows // 3)
    shares = {1: sample_share(sizes.get(1, 0), rows // 3), 0: sample_share(sizes.get(0, 0), rows - toxic)}
    chosen = known.where(
        ((F.col("toxic") == 1) & hashed_share("id", shares[1])) | ((F.col("toxic") == 0) & hashed_share("id", shares[0]))
    )
    # The chosen ids are bounded by the parameter, so they are sent to the documents.
    sample = texts(docs, id_col, text_col).join(F.broadcast(chosen), "id").select("id", "toxic", "text")
    schema = "id bigint, toxic int, total bigint, words array<string>, counts array<bigint>"
    bags = Steps(docs.sparkSession).store(arrow_map(sample, _bags, schema))
    # The words are counted where they are; the driver gets each once and numbers of them.
    words = bags.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = sorted(words.where(F.col("n") >= LEAST).select("word").toArrow()["word"].to_pylist())
    coded = arrow_map(
        bags, _coded(docs.sparkSession.sparkContext.broadcast(vocabulary)),
        "id bigint, toxic int, total bigint, codes array<int>, counts array<int>",
    )
    found = coded.orderBy("id", "total").toArrow()  # the same model on every run
    codes, counts = (found[c].combine_chunks() for c in ("codes", "counts"))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(codes).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return train(
        vocabulary, codes.flatten().to_numpy(), counts.flatten().to_numpy(), ends, found["total"].to_numpy(),
        found["toxic"].to_numpy().astype(np.int64),
    )


def _table(model: Model) -> WordTable:
    """The word weights of a model, one table per worker and model."""
    name = (len(model.grams), model.bias, float(model.weights.sum()), float(np.abs(model.weights).sum()))
    return per_worker("toxicity", name, lambda: WordTable(model.word_weights))


def score(model: Model, text: Column) -> Column:
    """The score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lines in batches:
            found = [
                model.scores(part["text"].to_pylist(), _table(model))
                for part in slices(pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["text"]))
            ]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return scored(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row. A null id counts as learned from."""
    model = fit(docs, labels, id_col, text_col)
    ship(docs.sparkSession)
    held = F.coalesce(crc_bucket(id_col, FOLDS) == 0, F.lit(False))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), held.alias("held_out"), score(model, F.col(text_col)).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
