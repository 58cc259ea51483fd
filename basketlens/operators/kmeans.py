"""K-Means for many numbers of clusters and many starts at once.

All runs (k, start) go forward together: a round is one scan of the rows and one
aggregation, in which every running run's rows are assigned to its centres and summed.
A run leaves when its centres rest. So a sweep costs as many scans as its slowest run has
rounds, not the sum over all runs. Centres are the only state between rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from basketlens.functions.hashing import draw
from basketlens.shipping import map_batches

_U = np.uint64
#: Rows whose distances to all centres are worked on at a time.
BLOCK = 1024
#: Up to so many tasks hand their sums to the driver themselves; those of more are added up by tasks first.
PARTS = 64


@dataclass
class Run:
    k: int
    seed: int
    centres: np.ndarray
    inertia: float = float("nan")
    rounds: int = 0


@dataclass
class Sweep:
    runs: list[Run]
    scans: int = 0
    scores: list[tuple[int, float, float | None]] = field(default_factory=list)

    def best(self, k: int) -> Run:
        """The start with the lowest inertia, the first of equal ones."""
        return min((r for r in self.runs if r.k == k), key=lambda r: (r.inertia, r.seed))


def _points(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(1)
    return lists.flatten().to_numpy().reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def _uniform(hashes: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Draws in (0, 1] of (row, seed, step); the same whatever the partitions."""
    with np.errstate(over="ignore"):
        x = hashes + _U((seed * 1_000_003 + step) % (1 << 63)) * _U(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> _U(shift))) * _U(factor)
        x ^= x >> _U(31)
    return ((x >> _U(11)).astype(float) + 1) / float(1 << 53)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a line per centre."""
    squares = centres @ (2 * x).T
    np.subtract((x * x).sum(1)[None, :], squares, out=squares)
    squares += (centres * centres).sum(1)[:, None]
    return np.maximum(squares, 0.0, out=squares)


def _nearest(x: np.ndarray, runs: list[np.ndarray]) -> np.ndarray:
    """The centre of each row (the first of equally near ones), a line per run; all runs share one product."""
    squares = _squares(x, np.concatenate(runs))
    found = np.zeros((len(runs), len(x)), dtype=np.int64)
    start = number = 0
    # Runs of one size are neighbours: their centres are compared turn by turn, along the rows.
    for k, same in groupby(runs, len):
        n = len(list(same))
        block = squares[start : start + n * k].reshape(n, k, len(x))
        lowest, own = block[:, 0].copy(), found[number : number + n]
        for c in range(1, k):
            np.copyto(own, c, where=block[:, c] < lowest)
            np.minimum(lowest, block[:, c], out=lowest)
        start, number = start + n * k, number + n
    return found


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, x): the hashes and the numbers of a batch's rows, end to end."""
    for batch in batches:
        if batch.num_rows:
            packed = [pa.array([v.tobytes()], pa.binary()) for v in (batch.column(0).to_numpy(), _points(batch))]
            yield pa.RecordBatch.from_arrays(packed, names=["h", "x"])


def _packed(points: DataFrame, d: int) -> RDD:
    """(hashes, rows) as arrays, one pair per batch: every round reads them, so they are converted once."""

    def arrays(row):
        return np.frombuffer(row["h"], dtype=_U), np.frombuffer(row["x"]).reshape(-1, d)

    return map_batches(points, _pack, "h binary, x binary").rdd.map(arrays)


def _blocks(arrays: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """The rows, few at a time: their distances to all centres stay in the processor's cache."""
    for _, x in arrays:
        for start in range(0, len(x), BLOCK):
            yield x[start : start + BLOCK]


def _scan(points: RDD, work: Callable, merge: Callable):
    """What ``work`` makes of each partition's arrays, put together."""
    parts = points.mapPartitions(lambda arrays: [work(arrays)])
    return parts.reduce(merge) if parts.getNumPartitions() <= PARTS else parts.treeReduce(merge)


def _sums(points: RDD, runs: list[np.ndarray], d: int, costs: bool = False) -> dict[tuple[int, int], tuple[int, float, np.ndarray]]:
    """(run, centre) -> rows, their squared distances to it (0 unless ``costs``), their sum; one scan."""
    sizes = [len(c) for c in runs]
    first = np.cumsum(sizes) - sizes

    def work(arrays):
        # A line per centre: the sum of its rows, their number, their squared distances.
        total = np.zeros((sum(sizes), d + 2))
        for x in _blocks(arrays):
            near = _nearest(x, runs)
            held = np.zeros((len(total), len(x)))
            held[near + first[:, None], np.arange(len(x))] = 1.0
            total[:, : d + 1] += held @ np.column_stack([x, np.ones(len(x))])
            for r, own in enumerate(near if costs else ()):
                away = ((x - runs[r][own]) ** 2).sum(1)
                total[first[r] : first[r] + sizes[r], d + 1] += np.bincount(own, weights=away, minlength=sizes[r])
        return total

    total = _scan(points, work, np.add)
    lines = ((r, c, total[first[r] + c]) for r, size in enumerate(sizes) for c in range(size))
    return {(r, c): (int(line[d]), float(line[d + 1]), line[:d]) for r, c, line in lines if line[d] > 0}


def _spread_starts(points: RDD, runs: list[Run]) -> int:
    """Choose centres one after the other, far ones more likely, for all runs in the same scans; the scans.

    Of all rows the one with the smallest -ln(draw) / squared distance is a draw with
    weights proportional to those distances. A run with fewer distinct rows than k has fewer centres.
    Runs of one seed choose the same centres, as far as each goes, so a seed is one choice for all of them.
    """
    scans = 0
    for step in range(max(r.k for r in runs)):
        going: dict[int, list[Run]] = {}
        for run in runs:
            if len(run.centres) == step < run.k:
                going.setdefault(run.seed, []).append(run)
        if not going:
            break
        known = [(seed, own[0].centres) for seed, own in going.items()]

        def work(arrays, known=known, step=step):
            best = [None] * len(known)
            for hashes, x in arrays:
                for i, (seed, centres) in enumerate(known):
                    race = -np.log(_uniform(hashes, seed, step))
                    if step:
                        away = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
                        race = np.where(away > 0, race / np.where(away > 0, away, 1.0), np.inf)
                    low = race.min()
                    if np.isfinite(low) and (best[i] is None or low <= best[i][0]):
                        tied = [(float(low), int(hashes[at]), x[at].tolist()) for at in np.flatnonzero(race == low).tolist()]
                        best[i] = min(tied if best[i] is None else [best[i], *tied])
            return best

        def merge(a, b):
            return [min((v for v in pair if v is not None), default=None) for pair in zip(a, b, strict=True)]

        for own, best in zip(going.values(), _scan(points, work, merge), strict=True):
            for run in own if best is not None else ():
                run.centres = np.concatenate([run.centres, [best[2]]])
        scans += 1
    return scans


def _drawn_starts(df: DataFrame, key: str, vector: Column, runs: list[Run], d: int) -> int:
    """The rows with the smallest draws of the run's seed; one scan for each seed."""
    seeds = sorted({r.seed for r in runs})
    for seed in seeds:
        own = [r for r in runs if r.seed == seed]
        ordered = df.select(draw(f"kmeans{seed}", key).alias("draw"), F.col(key).alias("key"), vector.alias("x")).orderBy("draw", "key")
        first = np.array([r["x"] for r in ordered.limit(max(r.k for r in own)).collect()], dtype=float).reshape(-1, d)
        for run in own:
            run.centres = first[: run.k]
    return len(seeds)


def _silhouettes(points: RDD, chosen: list[Run], d: int) -> list[float | None]:
    """Mean silhouette (squared Euclidean) of each run's labels, all in two scans; None with one cluster."""
    runs = [r.centres for r in chosen]
    sums = _sums(points, runs, d, costs=True)
    sizes = [np.array([sums.get((r, c), (0,))[0] for c in range(len(runs[r]))]) for r in range(len(runs))]
    # Mean squared distance to a cluster: to its mean, plus the cluster's own mean squared distance to it.
    means, spreads = [], []
    for r, centres in enumerate(runs):
        own = [sums.get((r, c), (0, 0.0, centres[c])) for c in range(len(centres))]
        mean = np.array([s / max(n, 1) if n else s for n, _, s in own])
        means.append(mean)
        spreads.append(np.array([max(q / max(n, 1) - ((m - c) ** 2).sum(), 0.0) for (n, q, _), m, c in zip(own, mean, centres, strict=True)]))

    def work(arrays):
        widths = np.zeros((len(runs), 2))
        for x in _blocks(arrays):
            at = np.arange(len(x))
            for r, own in enumerate(_nearest(x, runs)):
                away = ((x[:, None, :] - means[r][None, :, :]) ** 2).sum(2) + spreads[r]
                n = sizes[r][own]
                inner = away[at, own] * n / np.maximum(n - 1, 1)
                away[at, own] = np.inf
                away[:, sizes[r] == 0] = np.inf
                outer = away.min(1)
                larger = np.maximum(inner, outer)
                fine = (n > 1) & (larger > 0) & np.isfinite(outer)
                widths[r, 0] += np.where(fine, (np.where(fine, outer, 0) - inner) / np.where(larger > 0, larger, 1.0), 0.0).sum()
                widths[r, 1] += len(x)
        return widths

    found = _scan(points, work, np.add)
    return [width / n if n and (sizes[r] > 0).sum() > 1 else None for r, (width, n) in enumerate(found)]


def _advance(points: RDD, sweep: Sweep, d: int, max_rounds: int, tolerance: float) -> None:
    """Rounds of all runs until each rests, and their inertias."""
    going = list(sweep.runs)
    while going:
        sums = _sums(points, [r.centres for r in going], d)
        sweep.scans += 1
        still = []
        for number, run in enumerate(going):
            centres = np.array([sums[number, c][2] / sums[number, c][0] if (number, c) in sums else old for c, old in enumerate(run.centres)])
            moved = ((centres - run.centres) ** 2).sum(1).max()
            run.centres, run.rounds = centres, run.rounds + 1
            if moved > tolerance**2 and run.rounds < max_rounds:
                still.append(run)
        going = still
    costs = _sums(points, [r.centres for r in sweep.runs], d, costs=True)
    sweep.scans += 1
    for number, run in enumerate(sweep.runs):
        run.inertia = sum(costs[number, c][1] for c in range(len(run.centres)) if (number, c) in costs)


def kmeans_sweep(
    df: DataFrame,
    key: str,
    vector: Column,
    ks: range = range(2, 9),
    restarts: int = 10,
    seed: int = 42,
    max_rounds: int = 300,
    tolerance: float = 1e-4,
    start: str = "spread",
    score: bool = True,
) -> Sweep:
    """Lloyd's iterations of every (k, start) at once: runs with centres and inertia, scores (k, inertia, silhouette).

    ``vector`` is an array of doubles, of one length and without gaps; rows without one are
    left out. ``start`` "spread" draws far rows as first centres, "draws" takes the rows with
    the smallest hashed draws of their key. A run ends when no centre moves further than
    ``tolerance``, or after ``max_rounds``; a centre without rows stays where it is. The rows are
    packed into arrays once, which every round reads; ``df`` should be a written or persisted
    table. A table without rows has no runs. The scores are of each k's best start, over all rows.
    """
    if start not in ("spread", "draws"):
        raise ValueError("start must be 'spread' or 'draws'")
    points = df.select(F.xxhash64(F.col(key)).alias("h"), vector.alias("x")).where("x is not null")
    first = points.select(F.size("x").alias("d")).first()
    if first is None:
        return Sweep([])
    d = first["d"]
    runs = [Run(k, seed + i, np.empty((0, d))) for k in ks for i in range(restarts)]
    sweep = Sweep(runs)
    packed = _packed(points, d).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if start == "spread":
            sweep.scans = _spread_starts(packed, runs)
        else:
            sweep.scans = _drawn_starts(df.where(vector.isNotNull()), key, vector, runs, d)
        _advance(packed, sweep, d, max_rounds, tolerance)
        if score:
            chosen = [sweep.best(k) for k in ks]
            widths = _silhouettes(packed, chosen, d)
            sweep.scans += 2
            sweep.scores = [(r.k, float(r.inertia), None if w is None else float(w)) for r, w in zip(chosen, widths, strict=True)]
    finally:
        packed.unpersist()
    return sweep
