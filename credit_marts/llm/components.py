"""Connected components of links: union-find inside tasks, alternating stars across them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, arrow_map

MOST_NODES = 500_000


class UnionFind:
    """Sets of nodes; the root of a set is its smallest node."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, node: int) -> int:
        path = []
        while (up := self.parent.setdefault(node, node)) != node:
            path.append(node)
            node = up
        for passed in path:
            self.parent[passed] = node
        return node

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int]]:
        """(node, root) of every node that is not a root."""
        return [(n, r) for n in list(self.parent) if (r := self.find(n)) != n]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch["hi"].to_pylist(), batch["lo"].to_pylist(), strict=True):
            sets.union(a, b)
        if len(sets.parent) > MOST_NODES:  # what was united so far is said by its stars
            yield _rows(sets)
            sets = UnionFind()
    yield _rows(sets)


def _rows(sets: UnionFind) -> pa.RecordBatch:
    stars = np.array(sets.stars(), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(stars[:, 0]), pa.array(stars[:, 1])], ["hi", "lo"])


def components(links: DataFrame, steps: Steps) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) but the smallest of each component,
    which is the component's name.

    Every task first unites its own links, so that it passes on at most one link per node. Rounds
    of large and small stars then hang all nodes under the smallest; each round is stored, so its
    joins read tables whose hot nodes adaptive execution can split. Links to oneself and repeated
    links change nothing; no link, no row.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges, before = steps.store(arrow_map(ordered, _forest, "hi bigint, lo bigint").distinct()), None
    while True:
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("sum")
        ).first()
        if seen["n"] == 0 or tuple(seen) == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        before = tuple(seen)
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = steps.store(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("least").alias("lo"))
        large = steps.store(large.distinct())
        lowest = steps.store(large.groupBy("hi").agg(F.min("lo").alias("least")))
        rest = large.join(lowest, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        edges = steps.store(lowest.select("hi", F.col("least").alias("lo")).unionAll(rest).distinct())
