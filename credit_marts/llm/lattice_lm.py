"""LM scoring: the probability of a text over all ways to write it with an existing vocabulary.

The vocabulary is that of a public subword tokenizer; it is never changed. A text is lower-cased
(A-Z only) and split at white space; every word is written with a mark before it, and a text ends
with an end sign. Pieces are drawn independently, so the probability of a text is the product over
its words of the sum over all segmentations of the product of their pieces, times the end's. The sum
comes from a forward recursion over the word's lattice in log space. Characters without a piece of
their own are written in bytes.

The vocabulary's own scores are the first weights, and stay a prior of PRIOR pieces: each round
counts the expected uses of every piece over all distinct training words, by forward and backward
sums, and the weights become the expected shares, until the likelihood grows by less than TOLERANCE.
Rounds run over the stored word counts of the whole corpus; one row per piece comes to the driver.

Texts are scored from a table of distinct words. Words that make up at least one in HOT tokens, HOT
of them at most, go to all tasks; a text's other words are counted per text, joined to the table and
added up per row, so no key of the join is hot and no vocabulary of the corpus is broadcast.

Null and empty texts have the end only. A null id counts as learned from. Repeated rows count each.
Very long texts and words are whole like all others. An empty table gives an empty table; without
training rows the prior alone scores. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, arrow_map, crc_bucket, slices

FOLDS, HELD_OUT = 7, 2
PRIOR = 10_000.0  # pieces that the vocabulary's own scores count for
TOLERANCE, MOST_ROUNDS = 0.001, 20
HOT = 400_000  # words that all tasks hold, at most
HOT_CHARS = 64  # of such a word
MOST_KEPT = 300_000  # distinct words a task adds up before it sends them
LATTICE_CHARS = 30_000  # characters of words whose lattices are built at a time

MARK, END = "▁", "\n"  # before a word; the end sign among words, which no word can be
_TEN = math.log(10.0)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts and then an end for each text, with the number of the text each is of."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # at \x20 and \x09-\x0D alone
    words = split.flatten()
    own = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    some = pc.greater(pc.binary_length(words), 0)
    ends = pa.array([END] * len(texts), words.type)
    return (
        pa.concat_arrays([words.filter(some), ends]),
        np.concatenate([own[some.to_numpy(zero_copy_only=False)], np.arange(len(texts))]),
    )


class Steps64:
    """Numbers by key in a few hash tables: a key lies in the first one whose slot was free for it, so
    looking up many keys takes two array reads for most of them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        odd = 0x9E3779B97F4A7C15
        while len(keys):
            slots = self._slots(keys, np.uint64(odd))
            _, first = np.unique(slots, return_index=True)
            own = np.full(1 << self.bits, -1, dtype=np.int64), np.zeros(1 << self.bits, dtype=np.int64)
            own[0][slots[first]], own[1][slots[first]] = keys[first], values[first]
            self.tables.append((np.uint64(odd), *own))
            keys, values = np.delete(keys, first), np.delete(values, first)
            odd = (odd * 0xBF58476D1CE4E5B9 | 1) & (1 << 64) - 1

    def _slots(self, keys: np.ndarray, odd: np.uint64) -> np.ndarray:
        return (keys.view(np.uint64) * odd >> np.uint64(64 - self.bits)).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key, -1 where there is none."""
        out, left = np.full(len(keys), -1, dtype=np.int64), None
        for odd, own, values in self.tables:
            wanted = keys if left is None else keys[left]
            slots = self._slots(wanted, odd)
            held = own[slots]
            good = held == wanted
            if left is None:
                out[good] = values[slots[good]]
                left = np.flatnonzero(~good & (held >= 0))  # a free slot: no table has the key
            else:
                out[left[good]] = values[slots[good]]
                left = left[~good & (held >= 0)]
            if not len(left):
                break
        return out


@dataclass
class Vocabulary:
    """Pieces as a trie in arrays, the bytes' numbers, and the share each piece has by its own score.

    Piece ``len(pieces)`` is the end.
    """

    pieces: list[str]
    prior: np.ndarray
    bytes_at: np.ndarray  # number of the piece of each byte

    def __post_init__(self) -> None:
        letters = sorted({ord(c) for piece in self.pieces for c in piece})
        self.letters = np.array([*letters, 0x110000], dtype=np.int64)
        number = {chr(c): i for i, c in enumerate(letters)}
        width, nodes, ends = len(letters) + 1, {}, {}
        for at, piece in enumerate(self.pieces):
            node = 0
            for c in piece:
                node = nodes.setdefault(node * width + number[c], len(nodes) + 1)
            if piece:
                ends[node] = at
        self.width = width
        self.steps = Steps64(np.array(list(nodes), dtype=np.int64), np.array(list(nodes.values()), dtype=np.int64))
        self.piece = np.full(len(nodes) + 1, -1, dtype=np.int64)
        for node, at in ends.items():
            self.piece[node] = at
        self.single = np.zeros(width, dtype=bool)  # letters that are pieces
        for piece in self.pieces:
            if len(piece) == 1:
                self.single[number[piece]] = True


def read_vocabulary(path: str, ranks: bool = True) -> Vocabulary:
    """Of a sentencepiece model with byte fallback. Its scores are natural logs of shares, or with
    ``ranks`` the negative places of its pieces by frequency, taken for Zipf's law."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, bytes_at = [], [], np.zeros(256, dtype=np.int64)
    for at in range(model.get_piece_size()):
        text = model.id_to_piece(at)
        if model.is_byte(at):
            bytes_at[int(text[3:-1], 16)] = len(pieces)
            pieces.append("")
            scores.append(None)
        elif not (model.is_control(at) or model.is_unknown(at) or model.is_unused(at)):
            pieces.append(text)
            scores.append(model.get_score(at))
    least = min(s for s in scores if s is not None)
    scores = np.array([least if s is None else s for s in scores])
    weights = 1.0 / (1.0 - scores) if ranks else np.exp(scores)
    weights = np.append(weights, weights.max())  # the end
    return Vocabulary(pieces, weights / weights.sum(), bytes_at)


class Lattice:
    """The arcs of the lattices of some words, by the places they lead to."""

    def __init__(self, words: pa.Array | list[str], vocabulary: Vocabulary) -> None:
        marked = pc.binary_join_element_wise(MARK, pa.array(words, pa.string()), "")
        sizes = pc.utf8_length(marked).to_numpy().astype(np.int64)
        text = "".join(marked.to_pylist())
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        stops = np.cumsum(sizes)
        begins = stops - sizes
        own = np.repeat(np.arange(len(words)), sizes)
        letter = np.searchsorted(vocabulary.letters, codes)
        known = vocabulary.letters[np.minimum(letter, len(vocabulary.letters) - 1)] == codes
        known &= (codes != ord(MARK)) | (np.arange(len(codes)) == begins[own])  # a mark inside is a character
        letter = np.where(known, letter, vocabulary.width - 1)
        self.words = len(words)
        # Place p of word w is begins[w] + w + p: words have one place more than characters.
        base = begins + np.arange(len(words))
        place_of, left = np.arange(len(codes)) + own, stops[own] - np.arange(len(codes))
        starts, ends, pieces = [], [], []
        at, node = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        depth = 0
        while len(at):
            node = vocabulary.steps(node * vocabulary.width + letter[at + depth])
            good = node >= 0
            at, node = at[good], node[good]
            depth += 1
            piece = vocabulary.piece[node]
            whole = piece >= 0
            starts.append(place_of[at[whole]])
            ends.append(starts[-1] + depth)
            pieces.append(piece[whole])
            inside = left[at] > depth
            at, node = at[inside], node[inside]
        # Bytes of characters without a piece: one arc that stands for all of them.
        odd = np.flatnonzero(~vocabulary.single[letter] | ~known)
        spelled = [vocabulary.bytes_at[list(chr(c).encode("utf-8", "surrogatepass"))] for c in codes[odd].tolist()]
        plain = sum(map(len, pieces))
        starts.append(place_of[odd])
        ends.append(starts[-1] + 1)
        pieces.append(np.full(len(odd), -1, dtype=np.int64))
        self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)
        self.pieces = np.concatenate(pieces)
        self.spelled, self.spelled_sizes = spelled, np.array([len(s) for s in spelled], dtype=np.int64)
        own_place = np.repeat(np.arange(len(words)), sizes + 1)
        place = np.arange(len(codes) + len(words)) - np.repeat(base, sizes + 1)  # from the begin of the word
        self.first, self.last = base, base + sizes
        self.places = len(place)
        # Arcs by how far from the word's begin they end, and by the place where they do.
        layer = place[self.ends]
        key = layer * self.places + self.ends
        order = np.argsort(key)
        key, layer = key[order], layer[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))  # arcs to one place stand together
        cuts = np.flatnonzero(np.diff(layer, prepend=-1))
        stops, runs = [*cuts[1:], len(order)], np.searchsorted(new, [*cuts, len(order)])
        self.order = order
        self.layers = [
            (slice(a, b), new[i:j] - a) for a, b, i, j in zip(cuts, stops, runs, runs[1:], strict=False)
        ]
        self.starts, self.ends, self.pieces = self.starts[order], self.ends[order], self.pieces[order]
        self.odd = np.flatnonzero(self.pieces < 0)
        self.bytes_of = order[self.odd] - plain  # which of the spelled characters
        self.word = own_place[self.starts]

    def weights(self, logs: np.ndarray) -> np.ndarray:
        """The log weight of every arc."""
        out = logs[np.maximum(self.pieces, 0)]
        if len(self.odd):
            begins = np.cumsum(self.spelled_sizes) - self.spelled_sizes
            out[self.odd] = np.add.reduceat(logs[np.concatenate(self.spelled)], begins)[self.bytes_of]
        return out

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Logs of the weight of all ways from a word's begin to each place."""
        sums = np.full(self.places, -np.inf)
        sums[self.first] = 0.0
        for arcs, begins in self.layers:
            values = sums[self.starts[arcs]] + weights[arcs]
            most = np.maximum.reduceat(values, begins)
            sizes = np.diff(np.append(begins, len(values)))
            total = np.add.reduceat(np.exp(values - np.repeat(most, sizes)), begins)
            sums[self.ends[arcs][begins]] = most + np.log(total)
        return sums

    def logs(self, logs: np.ndarray) -> np.ndarray:
        """The log probability of every word."""
        return self.forward(self.weights(logs))[self.last]

    def uses(self, logs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
        """How often each piece is expected in ``times`` of every word, and the log likelihood.

        From the end of every word back, a place hands what passes through it to the arcs that lead
        there, in proportion to their part of its sum.
        """
        weights = self.weights(logs)
        sums = self.forward(weights)
        share = np.exp(sums[self.starts] + weights - sums[self.ends])
        passing = np.zeros(self.places)
        passing[self.last] = times
        for arcs, _ in reversed(self.layers):
            share[arcs] *= passing[self.ends[arcs]]
            np.add.at(passing, self.starts[arcs], share[arcs])
        plain = self.pieces >= 0
        out = np.bincount(self.pieces[plain], share[plain], len(logs))
        if len(self.odd):
            spelled = [self.spelled[i] for i in self.bytes_of.tolist()]
            sizes = self.spelled_sizes[self.bytes_of]
            out += np.bincount(np.concatenate(spelled), np.repeat(share[self.odd], sizes), len(logs))
        return out, float(sums[self.last] @ times)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of a batch by their size, about LATTICE_CHARS at a time, and their rows."""
    words = batch["word"]
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    order = np.argsort(sizes, kind="stable")
    group = np.cumsum(sizes[order], dtype=np.int64) // LATTICE_CHARS
    for rows in np.split(order, np.flatnonzero(np.diff(group)) + 1) if len(order) else ():
        yield words.take(pa.array(rows)), rows


def _merged(parts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum"), ("learned", "sum")])
    return sums.select(["word", "n_sum", "learned_sum"]).rename_columns(["word", "n", "learned"])


def _counted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[pa.Table] = []
    for batch in found:
        for part in slices(batch):
            words, own = words_of(part["text"])
            coded = words.dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            learned = ~part["held_out"].to_numpy(zero_copy_only=False)
            n = [np.bincount(c, minlength=len(coded.dictionary)) for c in (code, code[learned[own]])]
            parts.append(pa.table([coded.dictionary, *map(pa.array, n)], ["word", "n", "learned"]))
            if sum(map(len, parts)) > 2 * MOST_KEPT:
                parts = [_merged(parts)]
                if len(parts[0]) > MOST_KEPT:
                    yield from parts.pop().to_batches()
    if parts:
        yield from _merged(parts).to_batches()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held = F.coalesce(crc_bucket("id", FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select("row", "id", held.alias("held_out"), "text")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, learned): occurrences in all texts and in training texts; the end is a word."""
    found = arrow_map(_rows(docs, id_col, text_col).select("held_out", "text"), _counted, "word string, n bigint, learned bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("learned").alias("learned"))


def shares(uses: np.ndarray, vocabulary: Vocabulary, prior: float = PRIOR) -> np.ndarray:
    """Logs of the expected shares, with the prior."""
    sums = uses + prior * vocabulary.prior
    return np.log(sums / sums.sum())


def fit(words: DataFrame, vocabulary: Vocabulary, tolerance: float = TOLERANCE) -> np.ndarray:
    """Log weights of the pieces and the end, learned from stored word counts."""
    learned = words.where("learned > 0")
    ends = learned.where(F.col("word") == END).agg(F.sum("learned")).first()[0] or 0
    learned = learned.where(F.col("word") != END).select("word", "learned")
    logs, before = np.log(vocabulary.prior), None
    for _ in range(MOST_ROUNDS):
        parts = arrow_map(learned, _used(vocabulary, logs), "piece int, uses double")
        uses, likelihood = np.zeros(len(logs)), 0.0
        for r in parts.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():  # one row per piece
            if r["piece"] < 0:
                likelihood = r["uses"]
            else:
                uses[r["piece"]] = r["uses"]
        uses[-1] = ends
        logs = shares(uses, vocabulary)
        if before is not None and likelihood - before <= tolerance * abs(before):
            break
        before = likelihood
    return logs


def _used(vocabulary: Vocabulary, logs: np.ndarray):
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses, likelihood = np.zeros(len(logs)), 0.0
        for batch in found:
            times = batch["learned"].to_numpy().astype(float)
            for words, rows in _blocks(batch):
                own, log = Lattice(words, vocabulary).uses(logs, times[rows])
                uses += own
                likelihood += log
        used = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(uses[used], likelihood))], ["piece", "uses"]
        )

    return batches


def word_scores(words: DataFrame, vocabulary: Vocabulary, logs: np.ndarray) -> DataFrame:
    """(word, n, learned, log): the log10 probability of every word."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            own = np.zeros(len(batch))
            for words, rows in _blocks(batch):
                own[rows] = Lattice(words, vocabulary).logs(logs)
                own[rows[pc.equal(words, END).to_numpy(zero_copy_only=False)]] = logs[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own / _TEN)], [*batch.schema.names, "log"])

    return arrow_map(words.select("word", "n", "learned"), batches, "word string, n bigint, learned bigint, log double")


def _looked_up(hot: Broadcast, below: float):
    """Sums over a text's hot words, and its other words with their numbers."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, logs = hot.value
        known = pa.array(known, pa.string())
        # Place -1, the last one, is that of all other words and adds nothing.
        values = [np.append(v, 0.0) for v in (counts > 0, np.log10(counts + 1.0) - below, logs)]
        for batch in found:
            for part in slices(batch):
                words, own = words_of(part["text"])
                at = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)
                tokens = np.bincount(own, minlength=len(part))
                sums = [np.bincount(own, v[at], len(part)) for v in values]
                other = at < 0
                rest = words.filter(pa.array(other)).dictionary_encode()
                size = max(len(rest.dictionary), 1)
                pairs, times = np.unique(own[other] * size + rest.indices.to_numpy(), return_counts=True)
                ends = np.cumsum([0, *np.bincount(pairs // size, minlength=len(part))])
                listed = pa.StructArray.from_arrays(
                    [rest.dictionary.take(pa.array(pairs % size)), pa.array(times, pa.int64())], ["word", "times"]
                )
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["id"], part["held_out"], pa.array(tokens, pa.int64()), pa.array(sums[0].astype(np.int64)),
                     pa.array(sums[1]), pa.array(sums[2]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed)],
                    ["row", "id", "held_out", "n_tokens", "known", "base", "score", "rest"],
                )

    return batches


_ROWS = (
    "row bigint, id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double, "
    "rest array<struct<word: string, times: bigint>>"
)


def scored(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    spark, steps = docs.sparkSession, Steps(docs.sparkSession)
    words = steps.store(word_counts(docs, id_col, text_col))
    logs = fit(words, vocabulary)
    words = steps.store(word_scores(words, vocabulary, logs))
    total, train, distinct = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0)), F.count(F.when(F.col("learned") > 0, 1))
    ).first()
    often = (F.col("n") * HOT >= total) & (F.char_length("word") <= HOT_CHARS)
    held = words.where(often).select("word", "learned", "log").toArrow()  # HOT words at most
    hot = spark.sparkContext.broadcast(
        (held["word"].to_pylist(), held["learned"].to_numpy(), held["log"].to_numpy())
    )
    below = math.log10(train + distinct + 1)
    rows = arrow_map(_rows(docs, id_col, text_col), _looked_up(hot, below), _ROWS)
    rows = steps.store(rows, codec="zstd")
    rest = rows.select("row", F.explode("rest").alias("own")).select("row", "own.*")
    rare = words.where(~often).select(
        "word", "learned", "log", (F.log10(F.col("learned") + 1) - F.lit(below)).alias("base")
    )
    times = F.col("times")
    sums = rest.join(rare, "word").groupBy("row").agg(
        F.sum(F.when(F.col("learned") > 0, times).otherwise(0)).alias("more_known"),
        F.sum(times * F.col("base")).alias("more_base"), F.sum(times * F.col("log")).alias("more_score"),
    )
    none = F.lit(0)
    return rows.drop("rest").join(sums, "row", "left").select(
        "id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", none)).alias("n_known"),
        F.lit(train).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", none)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", none)).alias("score"),
    )
