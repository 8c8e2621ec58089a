"""Toxicity: held-out accuracy, words no one has seen, and empty cases."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from credit_marts.llm import toxicity

BAD = ["stupid", "idiot", "worthless", "pathetic", "disgusting"]
GOOD = ["river", "mountain", "table", "window", "garden", "letter", "summer", "winter", "bridge", "forest", "the", "of", "and", "with"]


def made(n, seed=1):
    chance, docs, labels = random.Random(seed), [], []
    for i in range(n):
        words, toxic = [chance.choice(GOOD) + chance.choice(["", "s", "ly"]) for _ in range(chance.randint(5, 60))], chance.random() < 0.2
        for _ in range(max(1, len(words) // 20) if toxic else 0):
            words.insert(chance.randrange(len(words)), chance.choice(BAD))
        docs.append((i, " ".join(words), "id", 0.5))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = made(1500)
    docs += [(5000, None, "", 0.0), (5001, "", "", 0.0), (None, "the river", "", 0.0), (5002, "river " * 30_000, "", 0.0)]
    docs += [(5003, "the river with you idiotic stupids", "", 0.0), (5004, "a pathetik garden", "", 0.0), (5002, "river", "", 0.0)]
    labels += [(0, None), (None, 1), (99_999, 1)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, id string, score double"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    )


def test_held_out_documents(tables):
    docs, labels = tables
    rows = toxicity.scored(docs, labels).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None and r["doc_id"] != 99_999}
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows if r["id"] is not None)
    held = [r for r in rows if r["held_out"] and r["id"] in truth]
    assert len(held) > 200
    assert sum(r["predicted"] == truth[r["id"]] for r in held) / len(held) > 0.97
    by = {r["id"]: r["predicted"] for r in rows}
    assert by[5003] == 1 and by[5004] == 1  # words of no training text
    assert by[5000] == by[5001] == by[None] == by[5002] == 0


def test_labels_of_the_held_out_fold_are_not_used(tables, spark):
    docs, labels = tables
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert sorted(map(tuple, toxicity.scored(docs, labels).collect()), key=str) == sorted(
        map(tuple, toxicity.scored(docs, other).collect()), key=str
    )


def test_without_labels(tables):
    docs, labels = tables
    for none in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        assert {(r["score"], r["predicted"]) for r in toxicity.scored(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.scored(docs.limit(0), labels).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = toxicity.scored(docs, labels).join(labels.withColumnRenamed("doc_id", "id"), "id").where("held_out").collect()
    toxic, clean = ([r["predicted"] for r in held if r["toxic"] == t] for t in (1, 0))
    assert sum(toxic) / len(toxic) > 0.6 and sum(clean) / len(clean) < 0.06


def test_training_holds_few_copies_of_its_sample():
    chance = np.random.default_rng(3)
    docs, own, words = 3000, 400, 2000
    codes = np.concatenate([chance.permutation(words)[:own] for _ in range(docs)]).astype(np.int32)
    ends, totals, toxic = np.arange(docs + 1) * own, np.full(docs, own), (np.arange(docs) % 3 == 0).astype(np.int64)
    vocabulary = [f"word{i}" for i in range(words)]
    tracemalloc.start()
    model = toxicity.train(vocabulary, codes, np.ones_like(codes), ends, totals, toxic)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.grams) > words and peak < 12 * 8 * len(codes)  # 32 bytes a word and array before


def test_sums_of_blocks(monkeypatch):
    chance = np.random.default_rng(4)
    values, rows, share = chance.normal(size=(50, 4)), chance.integers(0, 50, 1000), chance.random(1000)
    ends = np.concatenate([[0, 0], np.sort(chance.integers(0, 1000, 30)), [1000, 1000]])
    expected = [(values[rows[a:b]] * share[a:b, None]).sum(0) for a, b in zip(ends, ends[1:])]
    for block in (1, 7, 100, 5000):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        assert np.allclose(toxicity._weighted(values, rows, share, ends), expected)


def test_most_toxic_documents_given_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = toxicity.scored(docs, labels).join(labels.withColumnRenamed("doc_id", "id"), "id").where("held_out").collect()
    toxic, clean = ([r["predicted"] for r in held if r["toxic"] == t] for t in (1, 0))
    assert sum(toxic) / len(toxic) >= 0.85 and sum(clean) / len(clean) < 0.04


def test_words_of_two_documents_are_learned(spark):
    docs, labels = made(2500)
    toxic = [i for i, t in labels if t and zlib.crc32(str(i).encode()) % 5][:2]
    docs = [(i, text + (" zyqqxov" if i in toxic else "")) for i, text, *_ in docs]
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert "<zyqqxov>" in model.grams


def test_joint_training_lowers_the_held_out_loss(monkeypatch):
    read = {t: pq.read_table(f"/root/testdata/sf0.1/{t}.parquet").to_pandas().set_index("doc_id") for t in ("documents", "labels")}
    rows = read["documents"].join(read["labels"], how="inner").sort_index()
    docs = [list(dict.fromkeys(toxicity.words_of(t or ""))) for t in rows["text"]]
    times = Counter(w for own in docs for w in own)
    names, toxic = {}, rows["toxic"].to_numpy().astype(np.int64)
    codes = [np.array([names.setdefault(w, len(names)) for w in own if times[w] > 1], np.int32) for own in docs]
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.index])
    learned = [c for c, h in zip(codes, held) if not h]
    ends, totals = np.cumsum([0, *map(len, learned)]), np.array([len(own) for own in docs])
    shaped = (list(names), np.concatenate(learned), np.ones(ends[-1]), ends, totals[~held], toxic[~held])

    def loss(model):
        words = model.word_weights(list(names))
        z = toxicity.SPREAD * np.array([words[c].sum() for c in codes]) / (totals + toxicity.BLANKS) + model.bias
        return np.logaddexp(0, np.where(toxic == 1, -z, z))[held].mean()

    both = toxicity.train(*shaped)
    monkeypatch.setattr(toxicity, "PATIENCE", 0)
    first = toxicity.train(*shaped)
    assert loss(both) < 0.97 * loss(first)
    ratio = both.weights @ first.weights / (first.weights @ first.weights)
    assert np.abs(both.weights - ratio * first.weights).max() > 0.01 * np.abs(first.weights).max()  # more than a scale
