"""Exact nearest neighbours of every row within a table, without comparing all pairs.

Identical vectors are first combined into one with a count, so a large group of
copies is a single row. The others lie in blocks of bounded size of a metric index
(``basketlens.operators.pivots``). A block is searched by one task; the distance to a
row's provisional k-th neighbour tells which other blocks can still hold a closer one.
A row visits the most promising of them first, and the rest with the smaller distance
that it knows then. Visitors of a popular block are spread over several tasks. The
index only steers the work: the result is the exact one for any blocks, and nothing
that grows with the table is held by the driver or broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from basketlens.functions.hashing import uniform
from basketlens.operators.ordering import running_totals
from basketlens.operators.pivots import SLACK, References, block_pairs, choose_references, least_distances, place, rings
from basketlens.shipping import ship
from basketlens.staging import stage

CELL_ROWS = 4096
SAMPLE_ROWS = 20_000
VISIT_ROWS = 20_000
MAX_BOX_NUMBERS = 100_000_000  # 800 MB of cell bounds held by the driver and each worker
BLOCK = 1_000_000  # distances computed at a time
#: Rings that a task compares its rows with, and blocks that a row visits before its radius is taken again.
RINGS = 1024
FIRST_VISITS = 4


class _Cells:
    """Binary cuts of space; a leaf's number is its cell."""

    def __init__(self) -> None:
        self.axis, self.at, self.low, self.high = [-1], [0.0], [-1], [-1]

    def cut(self, node: int, axis: int, at: float) -> tuple[int, int]:
        self.axis[node], self.at[node] = axis, at
        children = len(self.axis), len(self.axis) + 1
        self.low[node], self.high[node] = children
        for column, empty in ((self.axis, -1), (self.at, 0.0), (self.low, -1), (self.high, -1)):
            column.extend([empty, empty])
        return children

    def frozen(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(c) for c in (self.axis, self.at, self.low, self.high))


def _cell_of(x: np.ndarray, cells: tuple[np.ndarray, ...]) -> np.ndarray:
    axis, at, low, high = cells
    node = np.zeros(len(x), dtype=np.int64)
    moving = np.arange(len(x)) if axis[0] >= 0 else np.array([], dtype=np.int64)
    while len(moving):
        here = node[moving]
        above = x[moving, axis[here]] > at[here]
        node[moving] = np.where(above, high[here], low[here])
        moving = moving[axis[node[moving]] >= 0]
    return node


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def _assign(points: DataFrame, cells: _Cells) -> DataFrame:
    if len(cells.axis) == 1:
        return points.withColumn("cell", F.lit(0).cast("long"))
    shared = points.sparkSession.sparkContext.broadcast(cells.frozen())

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=_cell_of(_matrix(batch["vec"]), shared.value))

    return points.mapInPandas(assign, "rep long, copies long, vec array<double>, cell long")


def _bounds(assigned: DataFrame, d: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Cell -> rows, smallest and largest coordinates."""
    stats = assigned.groupBy("cell").agg(
        F.count("*").alias("n"),
        F.array(*[F.min(F.col("vec")[i]) for i in range(d)]).alias("lo"),
        F.array(*[F.max(F.col("vec")[i]) for i in range(d)]).alias("hi"),
    )
    return {r["cell"]: (r["n"], np.array(r["lo"]), np.array(r["hi"])) for r in stats.toLocalIterator()}


def _refine(cells: _Cells, node: int, sample: np.ndarray, leaves: int) -> bool:
    """Halve a cell at sample medians until it has the wanted number of leaves."""
    if leaves <= 1 or len(sample) < 8:
        return False
    axis = int(np.argmax(sample.max(0) - sample.min(0)))
    at = float(np.median(sample[:, axis]))
    above = sample[:, axis] > at
    if not above.any():
        at = float(sample[:, axis][sample[:, axis] < at].max(initial=-math.inf))
        above = sample[:, axis] > at
    if above.all() or not above.any():
        return False
    low, high = cells.cut(node, axis, at)
    _refine(cells, low, sample[~above], leaves // 2)
    _refine(cells, high, sample[above], leaves // 2)
    return True


def _partition(points: DataFrame, d: int, cell_rows: int) -> tuple[DataFrame, dict]:
    """Points with their cell, no cell holding more than ``cell_rows``."""
    cells = _Cells()
    attempt = 0
    while True:
        assigned = _assign(points, cells)
        bounds = _bounds(assigned, d)
        if attempt == 0:
            # Larger cells for very long tables, so that the cells' bounds stay within their limit.
            rows = sum(b[0] for b in bounds.values())
            cell_rows = max(cell_rows, math.ceil(8 * rows * d / MAX_BOX_NUMBERS))
        large = {c: b for c, b in bounds.items() if b[0] > cell_rows}
        if not large:
            return stage(assigned, "cells"), bounds
        if 2 * d * len(bounds) > MAX_BOX_NUMBERS:
            raise ValueError(f"{len(bounds)} cells: their bounds are too large to be shared")
        rate = min(1.0, SAMPLE_ROWS / sum(b[0] for b in large.values()))
        chosen = assigned.where(F.col("cell").isin(*large)) if len(large) < len(bounds) else assigned
        picked = chosen.where(uniform(f"cells{attempt}", "rep") < rate).select("cell", "vec").toPandas()
        samples = {c: _matrix(part["vec"]) for c, part in picked.groupby("cell")}
        for c, (n, lo, hi) in large.items():
            leaves = 2 ** math.ceil(math.log2(2 * n / cell_rows))
            if not _refine(cells, c, samples.get(c, np.empty((0, d))), leaves):
                # Too small a sample: the middle of the widest side always separates two points.
                axis = int(np.argmax(hi - lo))
                middle = lo[axis] + (hi[axis] - lo[axis]) / 2
                cells.cut(c, axis, float(middle if middle < hi[axis] else lo[axis]))
        attempt += 1


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def _nearest(d2: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest distances in order; equal ones by position."""
    if len(d2) > k:
        near = np.flatnonzero(d2 <= np.partition(d2, k - 1)[k - 1])
    else:
        near = np.arange(len(d2))
    return near[np.argsort(d2[near], kind="stable")][:k]


# What a block's search emits: neighbour candidates (q_*, d2), and rows that ask other blocks (radius, vec).
FOUND_SCHEMA = "rep long, q_rep long, q_copies long, d2 double, radius double, vec array<double>, cell long"


def _candidates(found: list[tuple[int, np.ndarray, np.ndarray]], reps: np.ndarray, copies: np.ndarray) -> pd.DataFrame:
    """One line per (row, neighbour) from (row's rep, neighbour positions, their distances)."""
    at = np.concatenate([near for _, near, _ in found]) if found else np.array([], dtype=np.int64)
    return pd.DataFrame(
        {
            "rep": np.repeat([rep for rep, _, _ in found], [len(near) for _, near, _ in found]).astype(np.int64),
            "q_rep": reps[at],
            "q_copies": copies[at],
            "d2": np.concatenate([d2 for _, _, d2 in found]) if found else np.array([]),
        }
    )


def _visit(visits: DataFrame, placed: DataFrame, k: int, visit_rows: int) -> DataFrame:
    """Candidates from other cells; a cell with many visitors is copied to several tasks."""
    spread = visits.groupBy("cell").agg(F.ceil(F.count("*") / visit_rows).cast("int").alias("tasks"))
    visitors = visits.join(spread, "cell").withColumn("task", F.pmod(F.xxhash64("rep"), "tasks").cast("int"))
    hosts = placed.join(spread, "cell").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))

    def search_visits(guests: pd.DataFrame, residents: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        reps = copies = np.array([], dtype=np.int64)
        if len(guests) and len(residents):
            residents = residents.sort_values("rep")
            x, y = _matrix(guests["vec"]), _matrix(residents["vec"])
            reps, copies = residents["rep"].to_numpy(), residents["copies"].to_numpy()
            limits, guest_reps = guests["radius"].to_numpy() * SLACK, guests["rep"].to_numpy()
            step = max(1, BLOCK // len(y))
            for start in range(0, len(x), step):
                for offset, d2 in enumerate(_squared(x[start : start + step], y)):
                    i = start + offset
                    near = _nearest(d2, k)
                    near = near[d2[near] <= limits[i]]
                    found.append((guest_reps[i], near, d2[near]))
        return _candidates(found, reps, copies)

    return (
        visitors.select("cell", "task", "rep", "radius", "vec")
        .groupBy("cell", "task")
        .cogroup(hosts.select("cell", "task", "rep", "copies", "vec").groupBy("cell", "task"))
        .applyInPandas(search_visits, "rep long, q_rep long, q_copies long, d2 double")
    )


def _turned(points: DataFrame, d: int, seed: int) -> DataFrame:
    """Points with their vectors turned by a random rotation, which keeps all distances."""
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]

    def rotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(vec=list(_matrix(batch["vec"]) @ turn))

    return points.mapInPandas(rotate, "rep long, copies long, vec array<double>")


def _within_cells(placed: DataFrame, k: int) -> DataFrame:
    """Candidates of every row from its own cell only."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        x, reps, copies = _matrix(pdf["vec"]), pdf["rep"].to_numpy(), pdf["copies"].to_numpy()
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        step = max(1, BLOCK // len(x))
        for start in range(0, len(x), step):
            block = _squared(x[start : start + step], x)
            block[np.arange(len(block)), start + np.arange(len(block))] = np.inf
            for offset, d2 in enumerate(block):
                near = _nearest(d2, k)
                near = near[np.isfinite(d2[near])]
                found.append((reps[start + offset], near, d2[near]))
        return _candidates(found, reps, copies)

    return placed.groupBy("cell").applyInPandas(search, "rep long, q_rep long, q_copies long, d2 double")


def _approximate(distinct: DataFrame, d: int, k: int, cell_rows: int, trees: int) -> DataFrame:
    """Candidates from the cells of several partitions, each of differently turned points."""
    parts = []
    for tree in range(trees):
        placed, _ = _partition(stage(_turned(distinct, d, tree), "turned"), d, cell_rows)
        parts.append(stage(_within_cells(placed, k), "near"))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("rep", "q_rep").agg(F.min("q_copies").alias("q_copies"), F.min("d2").alias("d2"))


def _own_block(placed: DataFrame, k: int) -> DataFrame:
    """Candidates of every row from its own block, and its radius if another block may hold a closer row."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        x, reps, copies = _matrix(pdf["vec"]), pdf["rep"].to_numpy(), pdf["copies"].to_numpy()
        radius = np.full(len(x), np.inf)
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        step = max(1, BLOCK // len(x))
        for start in range(0, len(x), step):
            for offset, d2 in enumerate(_squared(x[start : start + step], x)):
                i = start + offset
                missing = k - (copies[i] - 1)
                if missing <= 0:
                    radius[i] = -1.0
                    continue
                d2[i] = np.inf
                near = _nearest(d2, k)
                near = near[np.isfinite(d2[near])]
                reach = np.flatnonzero(np.cumsum(copies[near]) >= missing)
                if len(reach):
                    near = near[: reach[0] + 1]
                    radius[i] = d2[near[-1]]
                found.append((reps[i], near, d2[near]))
        asks = radius >= 0
        out = [
            _candidates(found, reps, copies).assign(radius=np.nan, vec=None),
            pd.DataFrame({"rep": reps[asks], "q_rep": pd.NA, "q_copies": pd.NA, "d2": np.nan, "radius": radius[asks], "vec": list(x[asks])}),
        ]
        numbers = {"q_rep": "Int64", "q_copies": "Int64"}
        return pd.concat([f.astype(numbers) for f in out if len(f)] or [out[0].astype(numbers)]).assign(cell=int(pdf["cell"].iloc[0]))

    return stage(placed.groupBy("cell").applyInPandas(search, FOUND_SCHEMA), "near")


def _visits(asks: DataFrame, pairs: DataFrame, references: References) -> DataFrame:
    """(cell, rep, radius, away): the blocks that may hold a row within a row's radius, by their rings.

    ``away`` is the least squared distance that the rings leave possible. A block's list of others is
    dealt over tasks by ``RINGS``. A row may visit every block, so a visit names its row and leaves the
    vector out: a task holds at most a block's rows times ``RINGS`` visits of four numbers.
    """
    parts = pairs.groupBy("block").agg(F.ceil(F.count("*") / RINGS).cast("int").alias("tasks"))
    lists = pairs.join(parts, "block").withColumn("task", F.pmod(F.xxhash64("other"), F.col("tasks")).cast("int"))
    rows = asks.withColumnRenamed("cell", "block").join(parts, "block")
    rows = rows.withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))

    def choose(guests: pd.DataFrame, rings_of: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"cell": [], "rep": [], "radius": [], "away": []})]
        if len(guests) and len(rings_of):
            x, limit = _matrix(guests["vec"]), np.sqrt(guests["radius"].to_numpy())
            ends = [rings_of[c].to_numpy() for c in ("cell", "near", "far")] + [_matrix(rings_of[c]) for c in ("low", "high")]
            step = max(1, BLOCK // len(rings_of))
            for start in range(0, len(x), step):
                gap = least_distances(x[start : start + step], references, *ends)
                i, b = np.nonzero(gap <= (limit[start : start + step] * SLACK)[:, None])
                out.append(
                    pd.DataFrame(
                        {
                            "cell": rings_of["other"].to_numpy()[b],
                            "rep": guests["rep"].to_numpy()[start + i],
                            "radius": guests["radius"].to_numpy()[start + i],
                            "away": gap[i, b] ** 2,
                        }
                    )
                )
        return pd.concat([f for f in out if len(f)] or out[:1])

    return (
        rows.select("block", "task", "rep", "radius", "vec")
        .groupBy("block", "task")
        .cogroup(lists.select("block", "task", "other", "cell", "near", "far", "low", "high").groupBy("block", "task"))
        .applyInPandas(choose, "cell long, rep long, radius double, away double")
    )


def _exact(indexed: DataFrame, references: References, k: int, visit_rows: int) -> DataFrame:
    """Candidates that hold the k nearest of every row."""
    placed = indexed.select("rep", "copies", "vec", F.col("block").alias("cell"))
    near = _own_block(placed, k)
    local = near.where(F.col("q_rep").isNotNull()).select("rep", "q_rep", "q_copies", "d2")
    asks = near.where(F.col("vec").isNotNull()).select("rep", "cell", "radius", "vec")
    of_blocks = rings(indexed, references)
    if of_blocks.count() < 2:
        return local
    radii = asks.groupBy(F.col("cell").alias("block")).agg(F.sqrt(F.max("radius")).alias("radius"))
    # No radius yet: any block may hold a neighbour.
    radii = radii.withColumn("radius", F.least("radius", F.lit(1e150)))
    pairs = stage(block_pairs(of_blocks, stage(radii, "radii"), references), "block-pairs")
    visits = stage(_visits(asks, pairs, references), "visits")
    first = Window.partitionBy("rep").orderBy("away", "cell")
    visits = visits.withColumn("turn", F.row_number().over(first))
    vectors = asks.select("rep", "vec")
    soon = stage(_visit(visits.where(F.col("turn") <= FIRST_VISITS).join(vectors, "rep"), placed, k, visit_rows), "near")
    known = stage(local.unionByName(soon), "near")
    # The k-th distance known by now, counting copies, is the radius of the later visits.
    in_order = Window.partitionBy("rep").orderBy("d2", "q_rep").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    twins = placed.select("rep", (F.col("copies") - 1).alias("twins"))
    reached = known.withColumn("upto", F.sum("q_copies").over(in_order)).join(twins, "rep").where(F.col("upto") + F.col("twins") >= k)
    reached = stage(reached.groupBy("rep").agg(F.min("d2").alias("now")), "radii")
    later = visits.where(F.col("turn") > FIRST_VISITS).join(reached, "rep", "left")
    later = later.withColumn("radius", F.least("radius", F.coalesce("now", F.lit(float("inf"))))).where(F.col("away") <= F.col("radius") * SLACK)
    return known.unionByName(_visit(later.join(vectors, "rep"), placed, k, visit_rows))


def nearest_neighbours(
    points: DataFrame, k: int, cell_rows: int = CELL_ROWS, visit_rows: int = VISIT_ROWS, trees: int = 0
) -> tuple[DataFrame, DataFrame]:
    """k nearest other rows of every row of ``points(key, vec[, copies])``, Euclidean, ties by smaller key.

    Returns ``(distinct, neighbours)``: ``distinct(rep, copies, vec)`` numbers the distinct
    vectors in the order of their smallest key (of any type, repeated or missing), and
    ``neighbours(rep, rank, distance, neighbour)`` has the vector at every rank. A
    ``copies`` column counts rows that were combined before.

    With ``trees`` the search is approximate: a row is compared with the rows of its own
    cell in so many partitions of differently turned points and with no others, so its work
    stays at ``trees * cell_rows`` however long the table and however many the dimensions.
    Distances are exact; a neighbour that shares none of the cells is missed.
    """
    ship(points.sparkSession)
    copies = F.sum("copies") if "copies" in points.columns else F.count("*")
    combined = points.groupBy("vec").agg(F.min("key").alias("key"), copies.alias("copies"))
    combined = combined.withColumn("one", F.lit(1).cast("long")).withColumn("vid", F.md5(F.col("vec").cast("string")))
    distinct = stage(
        running_totals(combined, [F.col("key"), F.col("vid")], {"rep": "one"}).select("rep", "copies", "vec"), "vectors"
    )
    first = distinct.select(F.size("vec").alias("d")).first()
    if first is None:
        raise ValueError("no rows to search")
    d = first["d"]
    if trees:
        return distinct, _ranked(_approximate(distinct, d, k, cell_rows, trees), distinct, k)
    references = choose_references(distinct, cell_rows)
    return distinct, _ranked(_exact(place(distinct, references, cell_rows), references, k, visit_rows), distinct, k)


def _ranked(candidates: DataFrame, distinct: DataFrame, k: int) -> DataFrame:
    """(rep, rank, distance, neighbour) from candidates, identical rows first."""
    in_order = Window.partitionBy("rep").orderBy("d2", "q_rep")
    kept = candidates.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= k)
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    others = (
        kept.withColumn("last", F.sum("q_copies").over(upto))
        .join(distinct.select("rep", (F.col("copies") - 1).alias("twins")), "rep")
        .withColumn("start", F.col("twins") + F.col("last") - F.col("q_copies") + 1)
        .where(F.col("start") <= k)
        .withColumn("rank", F.explode(F.sequence("start", F.least(F.col("twins") + F.col("last"), F.lit(k)))))
        .join(distinct.select(F.col("rep").alias("q_rep"), F.col("vec").alias("neighbour")), "q_rep")
        .select("rep", F.col("rank").cast("int").alias("rank"), F.sqrt("d2").alias("distance"), "neighbour")
    )
    twins = (
        distinct.where(F.col("copies") > 1)
        .withColumn("rank", F.explode(F.sequence(F.lit(1), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))))
        .select("rep", "rank", F.lit(0.0).alias("distance"), F.col("vec").alias("neighbour"))
    )
    return others.unionByName(twins)
