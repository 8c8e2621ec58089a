"""Lattice scores against sums over every segmentation written out."""

import math
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from credit_marts.llm import lattice_lm as lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return lm.read_vocabulary(PATH)


def segmentations(word, vocabulary):
    """Every way to write a word, as lists of piece numbers."""
    number = {p: i for i, p in enumerate(vocabulary.pieces) if p}

    @cache
    def rest(at):
        if at == len(text):
            return [[]]
        out = []
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in number and not (lm.MARK in text[max(at, 1) : end]):
                out += [[number[text[at:end]], *more] for more in rest(end)]
        if text[at] not in number or (text[at] == lm.MARK and at):
            spelled = [int(vocabulary.bytes_at[b]) for b in text[at].encode()]
            out += [[*spelled, *more] for more in rest(at + 1)]
        return out

    text = lm.MARK + word
    return rest(0)


WORDS = ["the", "hello", "aaaa", "straße", "日本語", "x", "▁a", "a▁b", "\U0001f600é", "ation", "q́z"]


def test_forward_sums_all_segmentations(vocabulary):
    logs = np.log(vocabulary.prior)
    got = lm.Lattice(WORDS, vocabulary).logs(logs)
    for word, value in zip(WORDS, got, strict=True):
        ways = segmentations(word, vocabulary)
        assert len(ways) > 0
        assert value == pytest.approx(math.log(sum(math.exp(sum(logs[p] for p in way)) for way in ways)), rel=1e-12)


def test_expected_uses(vocabulary):
    logs, times = np.log(vocabulary.prior), np.arange(1.0, len(WORDS) + 1)
    uses, likelihood = lm.Lattice(WORDS, vocabulary).uses(logs, times)
    expected, whole = np.zeros(len(logs)), 0.0
    for word, n in zip(WORDS, times, strict=True):
        ways = segmentations(word, vocabulary)
        chances = np.array([math.exp(sum(logs[p] for p in way)) for way in ways])
        whole += n * math.log(chances.sum())
        for way, chance in zip(ways, chances / chances.sum(), strict=True):
            for piece in way:
                expected[piece] += n * chance
    assert likelihood == pytest.approx(whole) and np.allclose(uses, expected)


DOCS = [(i, f"The {'hello ' * (i % 5)}word{i % 7}  of\tthe 日本 été\x0b{'rare' + str(i) if i % 3 else ''}") for i in range(120)] + [
    (500, None), (501, ""), (502, " \t\n"), (None, "null id the"), (3, "the same id again"), (503, "long words " * 20_000), (504, "y" * 30_000),
]


def lowered(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected_rows(docs, vocabulary):
    def held(key):
        return key is not None and zlib.crc32(str(key).encode()) % 7 == 2

    counts = Counter(w for i, t in docs if not held(i) for w in [*lowered(t), lm.END])
    total, distinct = sum(counts.values()), len(counts)
    words = sorted(w for w in counts if w != lm.END)
    logs, before = np.log(vocabulary.prior), None
    for _ in range(lm.MOST_ROUNDS):
        uses, likelihood = np.zeros(len(logs)), 0.0
        if words:
            uses, likelihood = lm.Lattice(words, vocabulary).uses(logs, np.array([counts[w] for w in words], float))
        uses[-1] = counts[lm.END]
        logs = np.log((uses + lm.PRIOR * vocabulary.prior) / (uses.sum() + lm.PRIOR))
        if before is not None and likelihood - before <= lm.TOLERANCE * abs(before):
            break
        before = likelihood
    rows = []
    for key, text in docs:
        tokens = [*lowered(text), lm.END]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        own = lm.Lattice(tokens[:-1], vocabulary).logs(logs).sum() if len(tokens) > 1 else 0.0
        rows.append((key, held(key), len(tokens), sum(counts[w] > 0 for w in tokens), total, base, (own + logs[-1]) / math.log(10)))
    return rows


def close(got, expected):
    def order(rows):
        return sorted((tuple(r) for r in rows), key=lambda r: (str(r[0]), r[2], r[3]))

    assert len(got) == len(expected)
    for a, b in zip(order(got), order(expected), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("hot", [100_000, 5])
def test_whole_table(spark, vocabulary, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT", hot)
    frame = spark.createDataFrame([(i, t, 1, "w") for i, t in DOCS], "doc_id bigint, text string, score int, word string").repartition(4)
    close(lm.scored(frame, vocabulary).collect(), expected_rows(DOCS, vocabulary))


def test_empty_table_and_no_training_rows(spark, vocabulary):
    frame = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    assert lm.scored(frame.limit(0), vocabulary).collect() == []
    only = [(i, t) for i, t in DOCS if i is not None and zlib.crc32(str(i).encode()) % 7 == 2][:5]
    rows = lm.scored(spark.createDataFrame(only, "doc_id bigint, text string"), vocabulary).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows) and len(rows) == 5


def test_rounds_raise_the_likelihood_of_held_out_texts(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = lm.word_counts(docs).cache()
    held = [(r["word"], r["n"] - r["learned"]) for r in words.where(f"n > learned AND word <> '{lm.END}'").collect()]
    logs = lm.fit(words, vocabulary)
    lattice, times = lm.Lattice([w for w, _ in held], vocabulary), np.array([n for _, n in held], float)
    assert lattice.logs(logs) @ times > 0.85 * (lattice.logs(np.log(vocabulary.prior)) @ times)
    assert np.exp(logs).sum() == pytest.approx(1.0)


def test_words_are_split_at_ascii_space_alone():
    texts = ["", " \t", "A\x0bB\x0cC\rD\nE", "É x\x1cY\x85z  Ü", "  one  TWO "]
    words, own = lm.words_of(pa.array(texts, pa.string()))
    by_text = [[w for w, i in zip(words.to_pylist(), own.tolist()) if i == n] for n in range(len(texts))]
    assert by_text == [[*lowered(t), lm.END] for t in texts]


def test_words_sent_in_parts(monkeypatch):
    texts = [f"a b{i % 3} c{i} a" for i in range(50)]
    whole = Counter(w for t in texts for w in [*t.split(), lm.END])
    learned = Counter(w for i, t in enumerate(texts) if i % 4 for w in [*t.split(), lm.END])
    held = pa.array([i % 4 == 0 for i in range(50)])
    batches = [pa.RecordBatch.from_arrays([held, pa.array(texts)], ["held_out", "text"]).slice(i, 5) for i in range(0, 50, 5)]
    for most in (1, 20, 1000):
        monkeypatch.setattr(lm, "MOST_KEPT", most)
        sums = Counter(), Counter()
        for r in pa.Table.from_batches(lm._counted(iter(batches))).to_pylist():
            sums[0][r["word"]] += r["n"]
            sums[1][r["word"]] += r["learned"]
        assert sums[0] == whole and +sums[1] == learned
