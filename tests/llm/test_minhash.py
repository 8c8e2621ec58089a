"""MinHash near-dedup against all pairs; signatures against the direct definition."""

import random

import numpy as np
import pytest
from plain_pairs import all_pairs

from credit_marts.llm import minhash
from credit_marts.llm.components import UnionFind, components
from credit_marts.llm.common import Steps

SF = "/root/testdata/sf0.001"


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in rows)
    return {r["id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_signature_is_the_lowest_bid_of_each_place():
    chance, places = np.random.default_rng(1), 24
    sets = [np.unique(chance.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 3, 30, 900)]
    got = minhash.super_minhash(sets, places)
    for row, shingles in zip(got, sets, strict=True):
        best = [2**64 - 1] * places
        for shingle in shingles:
            order = list(range(places))
            for rank in range(places):
                bits = int(minhash.mixed(np.array([(int(shingle) + (rank + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
                chosen = rank + ((bits & 0xFFFFFFFF) * (places - rank) >> 32)
                order[rank], order[chosen] = order[chosen], order[rank]
                best[order[rank]] = min(best[order[rank]], rank << 32 | bits >> 32)
        assert row.tolist() == best


def test_agreement_estimates_similarity():
    chance = np.random.default_rng(2)
    whole = chance.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(whole[:300]), np.unique(whole[100:])]
    signatures = minhash.super_minhash(sets, 960)
    assert abs((signatures[0] == signatures[1]).mean() - 0.5) < 0.06


def differences(pair):
    """Places in which two sketches differ, plane by plane."""
    a, b = (np.unpackbits(row.view(np.uint8)).reshape(minhash.PLANES, -1) for row in minhash.sketches(pair))
    return int((a != b).any(axis=0).sum())


def test_sketches_differ_little_where_sets_do():
    chance = np.random.default_rng(3)
    for n in (5, 20, 300):
        for _ in range(60):
            whole = np.unique(chance.integers(0, 2**63, n, dtype=np.uint64))
            pair = minhash.super_minhash([whole, whole[: -(-4 * len(whole) // 5)]], 960)  # at the threshold
            assert differences(pair) <= minhash.most_differences(960, 80)
    far = minhash.super_minhash([np.unique(chance.integers(0, 2**63, 300, dtype=np.uint64)) for _ in range(2)], 960)
    assert differences(far) > 2 * minhash.most_differences(960, 80)


def test_long_texts_are_bid_for_in_parts(monkeypatch):
    sets = [np.arange(1, 500, dtype=np.uint64), np.arange(1, 40, dtype=np.uint64)]
    whole = minhash.super_minhash(sets, 16)
    monkeypatch.setattr(minhash, "MOST_PLACES", 16 * 64)
    assert (minhash.super_minhash(sets, 16) == whole).all()


@pytest.mark.parametrize("size", [4, 5])
def test_groups_of_made_texts(spark, size):
    chance = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    docs, base = [], [chance.choice(words) for _ in range(80)]
    for _ in range(60):  # chains of small changes, and copies
        if chance.random() < 0.7:
            base = base[:]
            base[chance.randrange(len(base))] = chance.choice(words)
        elif chance.random() < 0.5:
            base = [chance.choice(words) for _ in range(chance.randint(3, 90))]
        docs.append((len(docs) * 3, " ".join(base).upper() if chance.random() < 0.3 else "\n".join(base)))
    docs += [(901, None), (902, ""), (903, " \t\n"), (904, "one two"), (905, "One TWO"), (906, "w1 w2 w3"), (907, "long " * 30000)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, id string, component int")
    expected = all_pairs(docs, size, 80)
    assert found(minhash.near_duplicates(frame.repartition(5), size=size)) == expected
    assert expected[904] == expected[905] == (1, 904)
    assert expected[901] == (0, 901)


def test_odd_rows(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A B c d e f"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, minhash.near_duplicates(frame, size=4).collect()), key=str)
    assert got == sorted(
        [(None, 3, None, True), (None, 0, None, True), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False)], key=str
    )
    assert minhash.near_duplicates(frame.limit(0)).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = all_pairs([(r["doc_id"], r["text"]) for r in docs.collect()], 4, 80)
    assert found(minhash.near_duplicates(docs, size=4)) == expected


def test_components_of_random_links(spark):
    chance = random.Random(9)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5000 + i) for i in range(1, 90)] + [(7, 7)]
    sets = UnionFind()
    for a, b in links:
        sets.union(a, b)
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(7)
    assert sorted(map(tuple, components(frame, Steps(spark)).collect())) == sorted(sets.stars())
    assert components(frame.limit(0), Steps(spark)).collect() == []
