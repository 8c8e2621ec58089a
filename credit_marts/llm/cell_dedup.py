"""Near-dedup of vectors: spherical k-means cells, blocked cosine products, one kept per group.

Vectors are compared when their labels are equal. Equal vectors of a label are one point with a
weight. Spherical k-means, fitted on a bounded sample, gives the cells, as many as the largest label
needs for cells of one block; a point lives in the cell of its nearest centre and visits every later
cell it could have a partner in: if a point of cell c and a visitor differ by at most the chord of
the threshold, the visitor lies no further than that from the plane between its own cell and c. So no
link is lost, whatever the sample was, and every pair of cells meets once. Within a cell, residents
and visitors are dealt into blocks of bounded size. Every two blocks of residents, and every block of
residents with every block of visitors, meet in products of two matrices; two blocks hand on a count
and a star of links for each of their points, never the pairs. A point is sent once for each block it
meets, so a label of one block is sent once.

Vectors that are null, empty, zero or hold null or non-finite components, and those with a null
label, link with nothing; so do vectors of different lengths. A null id is its own null component
and kept. Rows that share an id are linked as one. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credit_marts.llm.common import Steps, arrow_map, hashed_share, sample_share
from credit_marts.llm.components import UnionFind, components

FIT_ROWS = 20_000  # vectors that the centres are fitted on
MOST_CELLS = 1_024  # beyond it cells hold more than one block; the result is the same
CELL_POINTS = BLOCK = 8_192  # points per cell aimed at; points of a block
BLOCK_BYTES = 4 << 20  # of the vectors of a block: of long vectors it has fewer points
STRIP = 512  # points of one product with a block


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """Unit centres with the largest cosine to their points."""
    chance = np.random.default_rng(seed)
    centres = points[chance.choice(len(points), min(cells, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(points[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return np.unique(centres, axis=0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _units(points: np.ndarray) -> np.ndarray:
    scaled = points / np.abs(points).max(axis=1, keepdims=True)  # large components must not overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _links(left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs with a cosine of at least ``least``, a strip of the product at a time."""
    strips = [np.nonzero(left[i : i + STRIP] @ right.T >= least) for i in range(0, len(left), STRIP)]
    return (
        np.concatenate([x + i * STRIP for i, (x, _) in enumerate(strips)]), np.concatenate([y for _, y in strips])
    )


def at_most(points: int, dims: int) -> int:
    """So many points, or as many as BLOCK_BYTES hold."""
    return min(points, max(64, BLOCK_BYTES // (8 * dims)))


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row: the other vectors with a cosine of at least
    ``least``, and the smallest id reachable by such links."""
    spark = vectors.sparkSession
    steps = Steps(spark)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')"
    usable = f"""id IS NOT NULL AND label IS NOT NULL AND coalesce(size(vector), 0) > 0
        AND coalesce(forall(vector, {finite}), false) AND exists(vector, x -> x <> 0)"""
    rows = steps.store(rows.withColumn("usable", F.coalesce(F.expr(usable), F.lit(False))))
    points = rows.where("usable").groupBy("label", "vector").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")
    )
    points = steps.store(points.withColumn("dims", F.size("vector")).withColumn("point", F.monotonically_increasing_id()))

    per_label = points.groupBy("dims", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = per_label.groupBy("dims").agg(F.sum("n").alias("rows"), F.max("n").alias("most")).orderBy("dims").collect()
    found = [_of_size(points.where(F.col("dims") == r["dims"]), *r, least, steps) for r in sizes]
    schema = "point bigint, rep bigint, partner bigint, links bigint"
    blocks = spark.createDataFrame([], schema)
    for part in found:
        blocks = blocks.unionAll(part)
    blocks = steps.store(blocks)
    united = components(blocks.where("partner IS NOT NULL").select(F.col("rep").alias("a"), F.col("partner").alias("b")), steps)
    counts = blocks.groupBy("point").agg(F.sum("links").alias("links"))
    named = points.join(counts, "point", "left").join(
        united.select(F.col("node").alias("rep"), "component"), "rep", "left"
    )
    named = steps.store(named.select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    ))
    linked = rows.where("usable").join(named, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _of_size(points: DataFrame, dims: int, rows: int, most: int, least: float, steps: Steps) -> DataFrame:
    """(point, rep, partner, links) of the points with vectors of one length; ``most`` have one label."""
    block = at_most(BLOCK, dims)
    cells = min(MOST_CELLS, -(-most // at_most(CELL_POINTS, dims)))
    centres = np.eye(1, dims)
    if cells > 1:
        fitted = points.where(hashed_share("point", sample_share(rows, FIT_ROWS))).select("vector").limit(2 * FIT_ROWS)
        sample = fitted.toArrow()["vector"].combine_chunks()
        centres = spherical_kmeans(_units(_matrix(sample, dims)), cells) if len(sample) else centres
    chord = float(np.sqrt(2 - 2 * least)) + 1e-9

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths = chord * np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T)) + 1e-12
        for whole in batches:
            for at in range(0, len(whole), STRIP):
                batch = whole.slice(at, STRIP)
                near = _units(_matrix(batch["vector"], dims)) @ centres.T
                home = near.argmax(1)
                gap = near[np.arange(len(home)), home][:, None] - near
                row, cell = np.nonzero((gap <= widths[home]) & (np.arange(len(centres)) >= home[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(pa.array(row)) for c in batch.columns], pa.array(cell.astype(np.int32)), pa.array(home[row] == cell)],
                    [*batch.schema.names, "cell", "resident"],
                )

    base = "label string, vector array<double>, rep bigint, weight bigint, point bigint"
    columns = ["label", "vector", "rep", "weight", "point"]
    placed = steps.store(arrow_map(points.select(*columns), assigned, f"{base}, cell int, resident boolean"))
    counts = placed.groupBy("label", "cell").agg(
        F.ceil(F.count_if("resident") / block).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("resident")) / block).cast("int").alias("guests"),
    )
    counts = steps.store(counts.where("homes > 0"))
    # Blocks of a cell are numbered, those of residents first; two blocks that meet are (i, j), i <= j.
    dealt = placed.join(counts, ["label", "cell"]).withColumn("spread", F.xxhash64("point"))
    dealt = dealt.withColumn("block", F.expr(
        "CAST(CASE WHEN resident THEN pmod(spread, homes) ELSE homes + pmod(spread, guests) END AS INT)"
    ))
    meets = F.expr("""transform(sequence(0, CASE WHEN resident THEN homes + guests ELSE homes END - 1),
        other -> struct(least(block, other) AS i, greatest(block, other) AS j))""")
    sent = dealt.select(*columns, "cell", "block", F.explode(meets).alias("pair")).select(*columns, "cell", "block", "pair.*")

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        out = {"point": [], "rep": [], "partner": [], "links": []}
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        ours, theirs = group[group["block"] == i], group[group["block"] == j]
        if len(ours) and len(theirs):
            a = _units(np.stack(ours["vector"].to_numpy()).astype(np.float64))
            b = a if i == j else _units(np.stack(theirs["vector"].to_numpy()).astype(np.float64))
            x, y = _links(a, b, least)
            if i == j:
                x, y = x[x < y], y[x < y]
            sets = UnionFind()
            for own, other, at, to in ((ours, theirs, x, y), (theirs, ours, y, x)):
                weights = np.bincount(at, weights=other["weight"].to_numpy()[to], minlength=len(own)).astype(np.int64)
                hit = np.flatnonzero(weights)
                out["point"] += own["point"].to_numpy()[hit].tolist()
                out["rep"] += own["rep"].to_numpy()[hit].tolist()
                out["partner"] += [None] * len(hit)
                out["links"] += weights[hit].tolist()
            for p, q in zip(ours["rep"].to_numpy()[x].tolist(), theirs["rep"].to_numpy()[y].tolist(), strict=True):
                sets.union(p, q)
            stars = sets.stars()
            out["point"] += [-1] * len(stars)
            out["rep"] += [s[0] for s in stars]
            out["partner"] += [s[1] for s in stars]
            out["links"] += [0] * len(stars)
        return pd.DataFrame(out).astype("Int64")

    grouped = sent.groupBy("label", "cell", "i", "j")
    return grouped.applyInPandas(compared, "point bigint, rep bigint, partner bigint, links bigint")
