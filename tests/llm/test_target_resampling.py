"""Importance resampling against sums over plain word lists."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from credit_marts.llm import target_resampling as resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text, sizes):
    words = WORD.findall(lowered(text))
    return words, [" ".join(words[i : i + n]) for n in range(sizes[0], sizes[1] + 1) for i in range(len(words) - n + 1)]


def plain(docs, targets, sizes=(1, 1), buckets=10_000, percent=10, least=20, seed=2024):
    """(id, n_features, weight, score, rank) of every row, sorted."""
    def counts(texts):
        return Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t, sizes)[1])

    source, wanted = counts(t for _, t in docs), counts(targets)
    s_all, t_all, rows = sum(source.values()), sum(wanted.values()), []
    for key, text in docs:
        words, found = grams(text, sizes)
        weight = 0
        for g in found:
            b = zlib.crc32(g.encode()) % buckets
            likelier = (wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))
            weight += math.floor(1000 * math.log(likelier))
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(words) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("id", "n_features", "weight", "score", "rank").collect()), key=str)


def some_docs():
    chance = random.Random(3)
    words = ["Straße", "été", "the", "x1", "42", "of", "Kelvin", "a_b", "日本", "ÀB"] + [f"w{i}" for i in range(60)]
    docs = [(i, chance.choice([" ", ", ", "\n--\t"]).join(chance.choices(words, k=chance.randrange(60)))) for i in range(300)]
    docs += [(900, None), (901, ""), (902, "... !? \x00"), (None, "the of " * 15), (5, docs[5][1]), (903, "word " * 30_000)]
    return docs, ["the of the x1 w3", None, "", "w5 W5 w6 ÀB été"]


def test_all_sizes_against_plain_sums(spark):
    docs, targets = some_docs()
    frame = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id bigint, text string, weight int, rank string")
    wanted = spark.createDataFrame([(t, 1) for t in targets], "text string, row int")
    for options in ({}, {"sizes": (1, 3), "buckets": 97, "percent": 35, "least_words": 4, "seed": 7}):
        got = found(resampling.resampled(frame.repartition(5), wanted, **options))
        names = {"least_words": "least"}
        assert got == plain(docs, targets, **{names.get(k, k): v for k, v in options.items()})


def test_spans_overlap_and_keep_whole_words():
    data = resampling.collapsed("A-b  c\tÉd. ".encode())
    assert data == "a b c Éd".encode()
    assert [data[i:j].decode() for i, j in resampling.gram_spans(data, 2)] == ["a b", "b c", "c Éd"]
    assert list(resampling.gram_spans(data, 5)) == [] == list(resampling.gram_spans(b"", 1))


def test_drawn_rows_keep_their_columns(spark):
    docs, targets = some_docs()
    frame = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id bigint, text string, weight int, rank string")
    wanted = spark.createDataFrame([(t,) for t in targets], "text string")
    rows = resampling.drawn(frame, wanted)
    expected = sorted((r[0] for r in plain(docs, targets) if r[4]), key=str)
    assert rows.columns == frame.columns and sorted((r["doc_id"] for r in rows.collect()), key=str) == expected


def test_empty_tables_and_ties(spark):
    docs, targets = some_docs()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    wanted = spark.createDataFrame([(t,) for t in targets], "text string")
    assert found(resampling.resampled(frame.limit(0), wanted)) == []
    assert found(resampling.resampled(frame, wanted.limit(0))) == plain(docs, [])
    same = [(7, "one two " * 20)] * 30
    got = found(resampling.resampled(spark.createDataFrame(same, "doc_id bigint, text string").repartition(4), wanted))
    assert sorted(r[4] for r in got if r[4]) == [1, 2, 3] and len(got) == 30
