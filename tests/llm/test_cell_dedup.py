"""Vector near-dedup against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from credit_marts.llm import cell_dedup
from credit_marts.llm.components import UnionFind

SCHEMA = "vec_id bigint, embedding array<float>, label int, point int"


def all_pairs(rows, least=0.98):
    """(n_links, component) by id."""
    groups, links = UnionFind(), {i: 0 for i, *_ in rows}
    good = [
        (i, np.array(v, dtype=np.float32).astype(np.float64), label) for i, v, label, *_ in rows
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    for n, (i, v, label) in enumerate(good):
        for j, w, other in good[n + 1 :]:
            if label == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links[i] += 1
                links[j] += 1
                groups.union(i, j)
    return {i: (links[i], groups.find(i)) for i in links}


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in rows)
    return {r["id"]: (r["n_links"], r["component_id"]) for r in rows}


def made(n=700, dims=8, seed=3):
    chance, rows = np.random.default_rng(seed), []
    for i in range(n):
        if i and chance.random() < 0.6:
            near = rows[int(chance.integers(max(0, len(rows) - 40), len(rows)))][1]
            vector = np.array(near) * 2.0 + chance.normal(0, chance.choice([0, 0.03, 0.1]), dims)
        else:
            vector = chance.normal(0, 1, dims)
        rows.append((i * 2 + 1, [float(np.float32(x)) for x in vector / np.abs(vector).max()], int(chance.integers(0, 2)), 0))
    return rows


ODD = [
    (2, None, 1, 0), (4, [], 1, 0), (6, [0.0] * 8, 1, 0), (8, [None] + [1.0] * 7, 1, 0), (10, [float("nan")] * 8, 1, 0),
    (12, [float("inf")] + [1.0] * 7, 1, 0), (14, [1.0] * 8, None, 0), (16, [1.0] * 8, None, 0), (18, [1.0] * 3, 1, 0),
    (20, [2.0] * 3, 1, 0), (22, [1e30] * 8, 1, 0), (24, [2e30] * 8, 1, 0),
]


@pytest.mark.parametrize(("cell", "block"), [(2000, 2048), (25, 2048), (60, 16)])
def test_all_links_are_found(spark, monkeypatch, cell, block):
    monkeypatch.setattr(cell_dedup, "CELL_POINTS", cell)
    monkeypatch.setattr(cell_dedup, "BLOCK", block)
    rows = made() + ODD + [(3000 + i, [0.5] * 8, 0, 0) for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(cell_dedup.near_duplicates(frame)) == all_pairs(rows)


def test_odd_tables(spark):
    frame = spark.createDataFrame([(None, [1.0, 2.0], 1, 0), (1, [1.0, 2.0], 1, 0), (1, [1.0, 2.0], 1, 0)], SCHEMA)
    rows = sorted(map(tuple, cell_dedup.near_duplicates(frame).collect()), key=str)
    assert rows == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]
    assert cell_dedup.near_duplicates(frame.limit(0)).collect() == []
    assert cell_dedup.near_duplicates(frame.where(F.col("vec_id").isNull())).count() == 1


def test_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()]
    assert found(cell_dedup.near_duplicates(vectors)) == all_pairs(rows)


def test_centres_have_length_one():
    points = np.random.default_rng(1).normal(size=(500, 6))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres = cell_dedup.spherical_kmeans(points, 9)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1) and len(centres) == 9
    assert (points @ centres.T).max(1).mean() > (points @ points[:9].T).max(1).mean()
