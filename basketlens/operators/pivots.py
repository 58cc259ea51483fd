"""A metric index by reference points, kept as tables.

A bounded sample gives two sets of reference points: centres, as many as the table has
blocks but no more than ``CENTRES``, and a few guides that lie far from each other. Every
row lies in the cell of its nearest centre; a cell's rows are cut by their distance to the
centre into blocks of bounded size. A block's rings are the smallest and largest distances
of its rows to its centre and to every guide. By the triangle inequality a row closer than r
to q has, for every reference point, a distance within r of q's, so a block can only hold
one if all its rings come that near.

Blocks and rings are rows of tables, as many as the data needs; only the reference points
and one line per cell reach the driver. Pairs of blocks meet by a join on neighbouring cells.
"""

from __future__ import annotations

from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketlens.functions.hashing import draw, uniform
from basketlens.operators.ordering import running_totals
from basketlens.shipping import map_batches
from basketlens.staging import stage

CENTRES, GUIDES = 1024, 16
SAMPLE_ROWS = 20_000
#: Keep rounding from ruling out a block at exactly the radius: relative, and in parts of the distance.
SLACK, ROUNDING = 1 + 1e-9, 1e-9


class References(NamedTuple):
    centres: np.ndarray
    guides: np.ndarray


def choose_references(rows: DataFrame, block_rows: int, centres: int = CENTRES, guides: int = GUIDES) -> References:
    """Reference points from a bounded sample of ``rows`` (rep, vec), which are distinct."""
    n = rows.count()
    picked = rows.where(uniform("pivots", "rep") < SAMPLE_ROWS / n) if n > SAMPLE_ROWS else rows
    picked = picked.select("vec", draw("centres", "rep").alias("draw")).orderBy("draw").limit(2 * SAMPLE_ROWS)
    sample = np.array([r["vec"] for r in picked.collect()] or [rows.select("vec").first()["vec"]], dtype=float)
    away = ((sample - sample.mean(0)) ** 2).sum(1)
    found = []
    while len(found) < guides and (not found or away.max() > 0):
        found.append(sample[int(away.argmax())])
        apart = ((sample - found[-1]) ** 2).sum(1)
        away = apart if len(found) == 1 else np.minimum(away, apart)
    return References(sample[: max(1, min(centres, ceil(n / block_rows)))], np.array(found))


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """(row, point) distances."""
    out = np.zeros((len(x), len(points)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - points[None, :, i]) ** 2
    return np.sqrt(out)


def vectors_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def place(rows: DataFrame, references: References, block_rows: int) -> DataFrame:
    """``rows`` (rep, copies, vec) with their ``block``, ``cell`` and distance ``away`` from its centre; a written table.

    No block has more than ``block_rows`` rows.
    """
    centres = references.centres
    norms = (centres * centres).sum(1)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = vectors_of(batch.column(2))
                cell = (norms[None, :] - 2 * x @ centres.T).argmin(1)
                away = np.sqrt(((x - centres[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=["rep", "copies", "vec", "cell", "away"]
                )

    placed = map_batches(rows.select("rep", "copies", "vec"), run, "rep long, copies long, vec array<double>, cell int, away double")
    ordered = running_totals(placed.withColumn("one", F.lit(1).cast("long")), [F.col("away"), F.col("rep")], {"upto": "one"}, groups=("cell",))
    number = F.floor((F.col("upto") - 1) / F.lit(block_rows)).cast("long")
    block = (F.col("cell").cast("long") * F.lit(1 << 40) + number).alias("block")
    return stage(ordered.select("rep", "copies", "vec", "cell", "away", block), "pivot-rows")


def rings(placed: DataFrame, references: References) -> DataFrame:
    """(block, cell, n, near, far, low, high): a block's distances to its centre and, as arrays, to the guides; a written table."""
    guides = references.guides

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            block, cell, own = (batch.column(c).to_numpy() for c in ("block", "cell", "away"))
            away = distances(vectors_of(batch.column("vec")), guides)
            order = np.argsort(block, kind="stable")
            starts = np.flatnonzero(np.concatenate([[True], np.diff(block[order]) != 0]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[order][starts]),
                    pa.array(cell[order][starts]),
                    pa.array(np.diff(np.append(starts, len(order))).astype(np.int64)),
                    pa.array(np.minimum.reduceat(own[order], starts)),
                    pa.array(np.maximum.reduceat(own[order], starts)),
                    pa.array(list(np.minimum.reduceat(away[order], starts, axis=0))),
                    pa.array(list(np.maximum.reduceat(away[order], starts, axis=0))),
                ],
                names=["block", "cell", "n", "near", "far", "low", "high"],
            )

    parts = map_batches(placed, run, "block long, cell int, n long, near double, far double, low array<double>, high array<double>")
    low, high = (F.array(*[f(F.col(c)[j]) for j in range(len(guides))]).alias(c) for f, c in ((F.min, "low"), (F.max, "high")))
    return stage(
        parts.groupBy("block", "cell").agg(F.sum("n").alias("n"), F.min("near").alias("near"), F.max("far").alias("far"), low, high), "pivot-rings"
    )


def block_pairs(of_blocks: DataFrame, radii: DataFrame, references: References) -> DataFrame:
    """(block, other, cell, near, far, low, high): other blocks that may hold a row within the radius of a row of ``block``, with their rings.

    ``of_blocks`` are rings, ``radii`` (block, radius) the largest radius asked for in a block.
    """
    asked = of_blocks.join(radii, "block")
    # At most CENTRES cells: their extents and radii, and which cells come near each other.
    extents = {r["cell"]: r["far"] for r in of_blocks.groupBy("cell").agg(F.max("far").alias("far")).collect()}
    wanted = {r["cell"]: r["radius"] for r in asked.groupBy("cell").agg(F.max("radius").alias("radius")).collect()}
    cells, asking = np.array(sorted(extents), dtype=np.int64), np.array(sorted(wanted), dtype=np.int64)
    reach = np.array([extents[c] + wanted[c] * SLACK for c in asking.tolist()])[:, None] + np.array([extents[c] for c in cells.tolist()])[None, :]
    apart = distances(references.centres[asking], references.centres[cells]) if len(asking) else np.empty((0, len(cells)))
    i, j = np.nonzero(apart * (1 - ROUNDING) <= reach) if len(asking) else (asking, asking)
    near_cells = of_blocks.sparkSession.createDataFrame(
        pa.table({"cell": pa.array(asking[i].astype(np.int32)), "other_cell": pa.array(cells[j].astype(np.int32))})
    )
    hosts = of_blocks.select(F.col("block").alias("other"), F.col("cell").alias("other_cell"), *[F.col(c).alias(f"other_{c}") for c in ("near", "far", "low", "high")])
    both = asked.join(near_cells, "cell").join(hosts, "other_cell").where("block <> other")
    for g in range(len(references.guides)):
        slack = F.col("radius") * SLACK + F.col("high")[g] * ROUNDING
        both = both.where((F.col("other_low")[g] <= F.col("high")[g] + slack) & (F.col("other_high")[g] >= F.col("low")[g] - slack))
    return both.select("block", "other", F.col("other_cell").alias("cell"), *[F.col(f"other_{c}").alias(c) for c in ("near", "far", "low", "high")])


def least_distances(x: np.ndarray, references: References, cell: np.ndarray, near: np.ndarray, far: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(row, block): a distance that no row of the block can be nearer than, from its rings."""
    known, number = np.unique(cell, return_inverse=True)
    own = distances(x, references.centres[known])[:, number]
    gap = np.maximum(near[None, :] - own, own - far[None, :]) - ROUNDING * own
    away = distances(x, references.guides)
    for g in range(len(references.guides)):
        to = away[:, g, None]
        gap = np.maximum(gap, np.maximum(low[None, :, g] - to, to - high[None, :, g]) - ROUNDING * to)
    return np.maximum(gap, 0.0)
