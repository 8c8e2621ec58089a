"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from credit_marts.llm import permuterm
from credit_marts.llm.common import Steps


def counted(docs, least_chars=5, least_count=3):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if key is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(counts):
    rows, forms = {}, {}
    for word, n in counts.items():
        others = [w for w in counts if w != word and near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        forms[word] = form
        rows[word] = (n, len(others), form, counts[form] if form else None)
    out = set()
    for word, row in rows.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.add((word, *row, root))
    return out


def found(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def some_docs():
    chance = random.Random(5)
    stems = ["colour", "hello", "aaaaa", "éaéaé", "Àrbol", "banana", "letter"]
    words = []
    for _ in range(400):
        word = list(chance.choice(stems))
        for _ in range(chance.randrange(3)):
            at = chance.randrange(len(word))
            word[at : at + chance.randrange(2)] = chance.choice(["", "a", "l", "é", "ÿ", "E"])
        words.append("".join(word))
    docs = [(i, " ".join(chance.choices(words, weights=[1 / (j + 1) for j in range(400)], k=80))) for i in range(200)]
    return docs + [(3, docs[3][1]), (None, "hello helo " * 4), (800, None), (801, ""), (802, "a, b; ×÷ß 12"), (803, "hellol. " * 20_000)]


def test_all_pairs(spark):
    docs = some_docs()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, word string, n int").repartition(5)
    expected = plain(counted(docs))
    assert len([r for r in expected if r[3]]) > 50 and any(r[5] != (r[3] or r[0]) for r in expected)
    assert found(permuterm.variants(frame)) == expected


def test_long_words_use_digests(spark):
    long = "abcab" * 13
    words = [long[:63], long[:64], long, long + "c", long[:30] + "x" + long[30:], long[:30] + "x" + long[31:], "ab" * 3000, "ab" * 3000 + "b"]
    docs = [(None, " ".join([w] * (3 + 4 * i))) for i, w in enumerate(words)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert found(permuterm.variants(frame)) == plain(counted(docs))


def test_groups_that_cross_batches(spark):
    docs = some_docs()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found(permuterm.variants(frame)) == plain(counted(docs))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_prefixes_of_pairs_meet_once():
    for a, b in [("hello", "helo"), ("aaaa", "aaa"), ("abc", "abd"), ("abc", "ab"), ("abc", "bc")]:
        left = [(p, k) for p, k in permuterm.skipping_prefixes(a)]
        right = [(p, k) for p, k in permuterm.skipping_prefixes(b)]
        met = [(k, j) for p, k in left for q, j in right if p == q]
        used = [(k, j) for k, j in met if (k == j == permuterm.LAST or (k != permuterm.BASE and j != permuterm.BASE)) or (k == permuterm.LAST and j == permuterm.BASE)]
        assert len(used) == 1, (a, b)


def test_roots_and_empty_tables(spark):
    steps = Steps(spark)
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 7)], "id bigint, form bigint")
    assert {r["id"]: r["root"] for r in permuterm.roots(chain, steps).collect()} == {**{i: 20 for i in range(20)}, 100: 20}
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert found(permuterm.variants(empty)) == set()
