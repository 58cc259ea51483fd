"""Forests of the ML library for long tables, grown in arrays.

The library adds up a dense histogram per node and partition: at the deep levels of many trees
that is far more than the rows themselves. Here features are coded once by their place between
cuts. A node with more rows than ``NODE_ROWS`` is cut by histograms that all tasks add up; the
rows of a smaller one are dealt to a task, which grows all that is below it. Trees go in
waves, so that the dealt rows of a wave stay under ``WAVE_BYTES``.

The rules are the library's: Poisson bootstrap, weights, features tried at a node, bins, depth,
least draws of a child, leaves of one prediction put together. Draws are hashes of (tree, row)
and (tree, node, feature), so a tree does not depend on where its rows are. The nodes become a
model of the library through its saved form.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from basketlens.operators.kmeans import _uniform
from basketlens.shipping import map_batches, release_memory, ship
from basketlens.staging import brief_shuffles, discard, new_path, stage_path

_U = np.uint64
Learner = RandomForestClassifier | RandomForestRegressor
#: Rows packed into one line of the coded table.
BLOCK = 8192
#: Draws of a node that one task takes.
NODE_ROWS = 1_000_000
#: Bytes of rows that are dealt at a time.
WAVE_BYTES = 1 << 30
#: Bytes handed back by a dealing task at a time.
DEALT_BYTES = 8 << 20
#: Share of rows that a bootstrap of the table's size holds.
HELD = 1 - math.exp(-1)
#: Cumulated shares of rows that are drawn 0, 1, 2 ... times.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
#: Values that stand for a feature's distribution in a task, and rows that are added before they are chosen anew.
POINTS, SUMMARY_ROWS = 4096, 100_000
#: A gain must exceed this share of the node's sum of squares, else it is rounding.
ROUNDING = 1e-12
CODED = "block long, n int, y binary, w binary, codes binary"
DEALT = "tree int, node long, block long, draws binary, y binary, w binary, codes binary"
NODES = "tree int, node long, feature int, cut int, n long, w double, s double, q double, gain double"
_NAMES = [part.split()[0] for part in NODES.split(", ")]
_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * 4]
#: Waves are written one after the other, as their shuffle files go by a setting of the session.
_one_wave = threading.Lock()


def _shorter(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``POINTS`` of ascending values in equal distances of rank, each for the rows around it."""
    upto = np.cumsum(counts)
    at = np.searchsorted(upto, (np.arange(POINTS) + 0.5) * (upto[-1] / POINTS))
    held, times = np.unique(np.minimum(at, len(values) - 1), return_counts=True)
    return values[held], times * (upto[-1] / POINTS)


def _added(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and their rows."""
    known, place = np.unique(np.concatenate(values), return_inverse=True)
    return known, np.bincount(place, weights=np.concatenate(counts), minlength=len(known))


def _summaries(features: int):
    """(feature, values, counts): the values of a task's rows, all of them or ``POINTS``."""

    def run(batches):
        held: list[tuple[list, list]] = [([], []) for _ in range(features)]
        waiting = 0

        def shorten() -> None:
            for f, (values, counts) in enumerate(held):
                if values:
                    known, rows = _added(values, counts)
                    known, rows = _shorter(known, rows) if len(known) > POINTS else (known, rows)
                    held[f] = [known], [rows]

        for batch in batches:
            for f in range(features):
                if batch.column(f).null_count or np.isnan(values := batch.column(f).to_numpy()).any():
                    raise ValueError(f"feature {batch.schema.names[f]} has missing values")
                held[f][0].append(values.copy())
                held[f][1].append(np.ones(len(values)))
            waiting += batch.num_rows
            if waiting > SUMMARY_ROWS:
                shorten()
                waiting = 0
        shorten()
        for f, (values, counts) in enumerate(held):
            if values:
                columns = [pa.array([f], pa.int32()), *(pa.array([x[0].tobytes()], pa.binary()) for x in (values, counts))]
                yield pa.RecordBatch.from_arrays(columns, names=["feature", "values", "counts"])

    return run


def _between(low: float, high: float) -> float:
    middle = low + (high - low) / 2
    return middle if low <= middle < high else low


def chosen_cuts(values: np.ndarray, counts: np.ndarray, bins: int) -> list[float]:
    """Cuts between ascending values: between all of at most ``bins``, else where the rows below come nearest to the next share.

    As in the library, a value with many shares leaves closer cuts to the values behind it.
    """
    middles = [_between(a, b) for a, b in zip(values[:-1].tolist(), values[1:].tolist(), strict=True)]
    if len(middles) < bins:
        return middles
    share = counts.sum() / bins
    found, target = [], share
    for middle, before, after in zip(middles, *(np.cumsum(counts)[part].tolist() for part in (slice(None, -1), slice(1, None))), strict=True):
        if abs(before - target) < abs(after - target):
            found.append(middle)
            target += share
    return found[: bins - 1]


def _cuts(bins: int):
    """Cuts of one feature from the summaries of all tasks."""

    def run(key, table):
        values, counts = ([np.frombuffer(x.as_buffer()) for x in table.column(c)] for c in ("values", "counts"))
        cuts = chosen_cuts(*_added(values, counts), bins)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([cuts], pa.list_(pa.float64()))], names=["feature", "cuts"])

    return run


def cuts_of(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Ascending cuts of every feature over all rows, see ``chosen_cuts``.

    The rank of a cut is off by no more than a task's half ``POINTS``-th of its rows for each ``SUMMARY_ROWS`` of them.
    """
    numbers = rows.select(*[F.col(f).cast("double") for f in features])
    parts = map_batches(numbers, _summaries(len(features)), "feature int, values binary, counts binary")
    found = {r["feature"]: np.array(r["cuts"]) for r in parts.groupBy("feature").applyInArrow(_cuts(bins), "feature int, cuts array<double>").collect()}
    return [found[f] for f in range(len(features))]


def _pack(cuts: list[np.ndarray]):
    """The rows as blocks: (label, weight, features ...) to arrays end to end, features as codes."""

    def run(batches):
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                if part.column(0).null_count or part.column(1).null_count:
                    raise ValueError("labels and weights must not be missing")
                codes = np.empty((part.num_rows, len(cuts)), dtype=np.uint8)
                for f, own in enumerate(cuts):
                    codes[:, f] = np.searchsorted(own, part.column(2 + f).to_numpy(), side="left")
                y, w = (part.column(i).to_numpy() for i in range(2))
                columns = [[number], [part.num_rows], [y.tobytes()], [w.tobytes()], [codes.tobytes()]]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "n", "y", "w", "codes"])
                number += 1

    return run


def _blocks(batches, features: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number, labels, weights, codes) of the packed blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            y, w, codes = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=k) for c, k in ((2, float), (3, float), (4, np.uint8)))
            yield batch.column(0)[i].as_py(), y, w, codes.reshape(-1, features)


def _draws(block: int, n: int, tree: int, settings: _Settings) -> np.ndarray:
    """How often the tree draws each row of a block."""
    if not settings.bootstrap:
        return np.ones(n, dtype=np.uint8)
    rows = _U(block * BLOCK) + np.arange(n, dtype=_U)
    return np.searchsorted(POISSON, _uniform(rows, settings.seed, tree), side="left").astype(np.uint8)


def tried_features(tree: int, nodes: np.ndarray, features: int, tried: int, seed: int) -> np.ndarray:
    """Features that the nodes try, a line per node: those with the smallest draws, ascending."""
    if tried >= features:
        return np.tile(np.arange(features), (len(nodes), 1))
    places = (nodes.astype(_U) * _U(features))[:, None] + np.arange(features, dtype=_U)
    draws = _uniform(places, seed + 1, tree)
    return np.sort(np.argsort(draws, axis=1, kind="stable")[:, :tried], axis=1)


def _at(paths: tuple[np.ndarray, np.ndarray], codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Node of each row, down the cuts known so far."""
    feature, cut = paths
    node = np.ones(len(rows), dtype=np.int64)
    while len(moving := np.flatnonzero(feature[node] >= 0)):
        here = node[moving]
        node[moving] = 2 * here + (codes[rows[moving], feature[here]] > cut[here])
    return node


class _Best:
    """The cut with the largest gain of every node, the first of equal ones, found feature by feature."""

    def __init__(self, n: np.ndarray, w: np.ndarray, s: np.ndarray, q: np.ndarray, least: int):
        self.n, self.w, self.s, self.least = n, w, s, least
        self.gain, self.feature, self.cut = ROUNDING * q, np.full(len(n), -1), np.full(len(n), -1)

    def add(self, feature: np.ndarray, n: np.ndarray, w: np.ndarray, s: np.ndarray) -> None:
        """Sums per (node, code) of one feature of each node."""
        n, w, s = (np.cumsum(x, axis=1)[:, :-1] for x in (n, w, s))
        rest_n, rest_w, rest_s = self.n[:, None] - n, self.w[:, None] - w, self.s[:, None] - s
        fine = (n >= self.least) & (rest_n >= self.least) & (w > 0) & (rest_w > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fine, s * s / w + rest_s * rest_s / rest_w - (self.s * self.s / self.w)[:, None], -np.inf)
        cut = gain.argmax(axis=1)
        most = gain[np.arange(len(cut)), cut]
        better = most > self.gain
        self.gain[better], self.cut[better], self.feature[better] = most[better], cut[better], feature[better]


def grow(tree: int, root: int, draws: np.ndarray, y: np.ndarray, w: np.ndarray, codes: np.ndarray, settings: _Settings) -> list[np.ndarray]:
    """Columns of ``NODES`` for the subtree of ``root``, from all its rows."""
    bins, features = settings.bins, codes.shape[1]
    draws = draws.astype(float)
    plain, weight = bool((w == 1).all()), draws * w
    # Amounts are taken from their mean, which keeps digits; sums of classes are exact as they are.
    middle = 0.0 if settings.classes else float((weight * y).sum() / weight.sum())
    value = weight * (y - middle)
    square = value * (y - middle)
    columns, rows = np.ascontiguousarray(codes.T), np.arange(len(y))
    at, ids, level = np.zeros(len(y), dtype=np.int64), np.array([root]), int(root).bit_length() - 1
    found = []
    while len(ids):
        k = len(ids)
        n, ww, s, q = (np.bincount(at, weights=v, minlength=k) for v in (draws, weight, value, square))
        best = _Best(n, ww, s, q, settings.least)
        open_ = (n >= 2 * settings.least) & (q - s * s / ww > ROUNDING * q) & (level < settings.depth)
        if open_.any():
            # Rows of nodes that stay leaves are left behind.
            held = open_[at]
            place = np.cumsum(open_) - 1
            if not held.all():
                rows, at = rows[held], at[held]
                draws, weight, value, square = draws[held], weight[held], value[held], square[held]
            at = place[at]
            own = _Best(n[open_], ww[open_], s[open_], q[open_], settings.least)
            tried, cells = tried_features(tree, ids[open_], features, settings.tried, settings.seed), int(open_.sum()) * bins
            base = at * bins
            for j in range(tried.shape[1]):
                code = columns[j][rows] if tried.shape[1] == features else columns[tried[at, j], rows]
                cell = base + code
                sums = [np.bincount(cell, weights=v, minlength=cells).reshape(-1, bins) for v in ((draws, value) if plain else (draws, weight, value))]
                own.add(tried[:, j], sums[0], sums[0] if plain else sums[1], sums[-1])
            best.gain[open_], best.feature[open_], best.cut[open_] = own.gain, own.feature, own.cut
        split = best.feature >= 0
        found.append([ids, best.feature, best.cut, n, ww, s, q, np.where(split, best.gain, 0.0)])
        if not split.any():
            break
        if not split[open_].all():
            held = split[open_][at]
            rows, at = rows[held], at[held]
            draws, weight, value, square = draws[held], weight[held], value[held], square[held]
        of = np.flatnonzero(open_)[at]
        right = columns[best.feature[of], rows] > best.cut[of]
        children = np.cumsum(split) - 1
        at = 2 * children[of] + right
        ids = np.repeat(2 * ids[split], 2)
        ids[1::2] += 1
        level += 1
    ids, feature, cut, n, ww, s, q, gain = (np.concatenate(c) for c in zip(*found, strict=True))
    s, q = s + middle * ww, q + 2 * middle * s + middle * middle * ww
    return [np.full(len(ids), tree), ids, feature, cut, np.rint(n), ww, s, q, gain]


class _Settings:
    """What a task needs to know of a forest."""

    def __init__(self, learner: Learner, features: int, bins: int):
        kind = learner.getFeatureSubsetStrategy()
        classes = isinstance(learner, RandomForestClassifier)
        if kind == "auto":
            kind = "all" if learner.getNumTrees() == 1 else "sqrt" if classes else "onethird"
        share = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3), "log2": max(1, math.ceil(math.log2(features)))}
        self.tried, self.bins, self.features, self.classes = share[kind], bins, features, classes
        self.trees, self.depth, self.least = learner.getNumTrees(), learner.getMaxDepth(), learner.getMinInstancesPerNode()
        self.bootstrap, self.seed = learner.getBootstrap(), learner.getSeed() % (1 << 40)


def _counted(wanted: dict[int, np.ndarray], paths: dict, settings: _Settings):
    """(tree, node, sums): histograms of the wanted nodes over a task's blocks, for the features that they try."""
    bins, features = settings.bins, settings.features

    def run(batches):
        tried = {t: tried_features(t, nodes, features, settings.tried, settings.seed) for t, nodes in wanted.items()}
        sums = {t: np.zeros((4, x.size * bins)) for t, x in tried.items()}
        for block, y, w, codes in _blocks(batches, features):
            for t, nodes in wanted.items():
                draws = _draws(block, len(y), t, settings)
                rows = np.flatnonzero(draws)
                node = _at(paths[t], codes, rows)
                at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
                held = nodes[at] == node
                rows, at = rows[held], at[held]
                n = draws[rows].astype(float)
                weight = n * w[rows]
                value = weight * y[rows]
                m = tried[t].shape[1]
                for j in range(m):
                    cell = (at * m + j) * bins + codes[rows, tried[t][at, j]]
                    for k, v in enumerate((n, weight, value, value * y[rows])):
                        sums[t][k] += np.bincount(cell, weights=v, minlength=sums[t].shape[1])
        for t, nodes in wanted.items():
            own = sums[t].reshape(4, len(nodes), -1)
            columns = [pa.array([t] * len(nodes), pa.int32()), pa.array(nodes), pa.array([own[:, i].tobytes() for i in range(len(nodes))], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "sums"])

    return run


def _cut(settings: _Settings):
    """The node with its best cut, and the draws of its children, from the histograms of all tasks."""

    def run(key, table):
        tree, node = (k.as_py() for k in key)
        # Always the same order: sums of amounts do not depend on which task ended first.
        parts = sorted(part.as_py() for part in table.column("sums"))
        total = np.sum([np.frombuffer(p) for p in parts], axis=0).reshape(4, settings.tried, settings.bins)
        n, w, s, q = (total[i, 0].sum(keepdims=True) for i in range(4))
        middle = 0.0 if settings.classes else s / w
        best = _Best(n, w, s - middle * w, q - middle * s, settings.least)
        tried = tried_features(tree, np.array([node]), settings.features, settings.tried, settings.seed)
        if node.bit_length() <= settings.depth:
            for j in range(settings.tried):
                best.add(tried[:, j], total[0, j][None], total[1, j][None], (total[2, j] - middle * total[1, j])[None])
        place = int(np.flatnonzero(tried[0] == best.feature[0])[0]) if best.feature[0] >= 0 else 0
        left = total[0, place, : best.cut[0] + 1].sum()
        values = [tree, node, int(best.feature[0]), int(best.cut[0]), int(n[0]), w[0], s[0], q[0], float(best.gain[0]) if best.feature[0] >= 0 else 0.0]
        columns = [pa.array([v], k) for v, k in zip([*values, int(left)], [*_KINDS, pa.int64()], strict=True)]
        return pa.table(columns, names=[*_NAMES, "below"])

    return run


def _dealt(nodes: dict[int, set[int]], paths: dict, settings: _Settings):
    """The drawn rows of the nodes, a line per node and block."""
    names = [part.split()[0] for part in DEALT.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]

    def run(batches):
        lines, size = [], 0
        for block, y, w, codes in _blocks(batches, settings.features):
            for t, wanted in nodes.items():
                draws = _draws(block, len(y), t, settings)
                rows = np.flatnonzero(draws)
                node = _at(paths[t], codes, rows)
                for own in np.unique(node).tolist():
                    if own in wanted:
                        held = rows[node == own]
                        parts = [x[held].tobytes() for x in (draws, y, w, codes)]
                        lines.append((t, own, block, *parts))
                        size += sum(map(len, parts))
                if size > DEALT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines, strict=True), kinds, strict=True)], names=names)
                    lines, size = [], 0
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lines, strict=True), kinds, strict=True)], names=names)

    return run


def _grown(settings: _Settings):
    """The subtree of a node, from its dealt rows in the order of their blocks."""

    def run(key, table):
        order = np.argsort(table.column("block").to_numpy())
        parts = {c: [table.column(c)[i].as_buffer() for i in order.tolist()] for c in ("draws", "y", "w", "codes")}
        draws, y, w, codes = (
            np.concatenate([np.frombuffer(x, dtype=k) for x in parts[c]]) for c, k in (("draws", np.uint8), ("y", float), ("w", float), ("codes", np.uint8))
        )
        found = grow(key[0].as_py(), key[1].as_py(), draws, y, w, codes.reshape(-1, settings.features), settings)
        del draws, y, w, codes, parts
        release_memory()
        return pa.table([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(found, _KINDS, strict=True)], names=_NAMES)

    return run


def _wave(coded: DataFrame, rows: int, trees: range, settings: _Settings) -> tuple[DataFrame, str]:
    """The node table of some trees, written."""
    spark = coded.sparkSession
    paths = {t: (np.full(2, -1), np.full(2, -1)) for t in trees}
    top, dealt, wide = [], {t: set() for t in trees}, {t: [1] for t in trees}
    if rows <= NODE_ROWS:
        dealt, wide = {t: {1} for t in trees}, {}
    while wide:
        asked = {t: np.array(sorted(nodes)) for t, nodes in wide.items()}
        parts = map_batches(coded, _counted(asked, paths, settings), "tree int, node long, sums binary")
        known = parts.groupBy("tree", "node").applyInArrow(_cut(settings), f"{NODES}, below long").collect()
        wide = {}
        for r in known:
            top.append(tuple(r)[:-1])
            if r["feature"] < 0:
                continue
            feature, cut = paths[r["tree"]]
            if 2 * r["node"] + 1 >= len(feature):
                more = np.full(2 * r["node"] + 2 - len(feature), -1)
                feature, cut = np.concatenate([feature, more]), np.concatenate([cut, more])
            feature[r["node"]], cut[r["node"]] = r["feature"], r["cut"]
            paths[r["tree"]] = feature, cut
            for child, n in ((2 * r["node"], r["below"]), (2 * r["node"] + 1, r["n"] - r["below"])):
                if n > NODE_ROWS:
                    wide.setdefault(r["tree"], []).append(child)
                else:
                    dealt[r["tree"]].add(child)
    number = sum(map(len, dealt.values()))
    found = spark.createDataFrame(top, NODES)
    if number:
        rows_of = map_batches(coded, _dealt(dealt, paths, settings), DEALT).repartition(number, "tree", "node")
        found = found.unionByName(rows_of.groupBy("tree", "node").applyInArrow(_grown(settings), NODES))
    with _one_wave, brief_shuffles(spark):
        return stage_path(found, "forest-nodes")


#: A node as the library saves it.
SAVED = (
    "treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, "
    "featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int"
)


def _library_nodes(cuts: list[np.ndarray], classes: bool):
    """A tree's nodes as the library saves them, numbered in preorder; leaves of one prediction are put together."""

    def run(key, table):
        order = np.argsort(table.column("node").to_numpy())
        node, feature, cut, n, w, s, q, gain = (table.column(c).to_numpy()[order] for c in _NAMES[1:])
        prediction = (2 * s > w).astype(float) if classes else s / w
        depth = np.array([int(x).bit_length() - 1 for x in node.tolist()])
        for level in range(int(depth.max()) - 1, -1, -1):
            inner = np.flatnonzero((depth == level) & (feature >= 0))
            left = np.searchsorted(node, 2 * node[inner])
            alike = (feature[left] < 0) & (feature[left + 1] < 0) & (prediction[left] == prediction[left + 1])
            feature[inner[alike]] = -1
        # A node stays if all above it are inner ones still.
        held = node == 1
        for level in range(1, int(depth.max()) + 1):
            own = np.flatnonzero(depth == level)
            above = np.searchsorted(node, node[own] // 2)
            held[own] = held[above] & (feature[above] >= 0)
        node, feature, cut, n, w, s, q, gain, prediction, depth = (x[held] for x in (node, feature, cut, n, w, s, q, gain, prediction, depth))
        inner = feature >= 0
        number = np.empty(len(node), dtype=np.int64)
        number[np.lexsort((depth, node << (int(depth.max()) - depth)))] = np.arange(len(node))
        below = np.searchsorted(node, 2 * node[inner])
        left, right = np.full(len(node), -1), np.full(len(node), -1)
        left[inner], right[inner] = number[below], number[below + 1]
        deviation = np.maximum(q - s * s / w, 0.0) / w
        stats = np.stack([w - s, s] if classes else [w, s, q], axis=1)
        threshold = [[float(cuts[f][c])] if f >= 0 else [] for f, c in zip(feature.tolist(), cut.tolist(), strict=True)]
        # Gini's impurity of two classes is twice the deviation of 0 and 1.
        scale = 2.0 if classes else 1.0
        tree, none = np.full(len(node), key[0].as_py()), np.full(len(node), -1)
        columns = [tree, number, prediction, scale * deviation, stats.tolist(), n, np.where(inner, scale * gain / w, -1.0), left, right, feature, threshold, none]
        names = [part.split()[0] for part in SAVED.split(", ")]
        whole = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}
        kinds = [whole[part.split()[1]] for part in SAVED.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _as_model(nodes: DataFrame, cuts: list[np.ndarray], learner: Learner, settings: _Settings):
    """The library's model of these nodes: a forest of the same settings without cuts is saved, its nodes replaced, and loaded."""
    spark = nodes.sparkSession
    label, features, weight = learner.getLabelCol(), learner.getFeaturesCol(), "weight"
    empty = [(float(i if settings.classes else 0), 1.0, Vectors.dense([0.0] * settings.features)) for i in range(2)]
    plain = learner.fit(spark.createDataFrame(empty, [label, weight, features]).coalesce(1))
    path = new_path(spark, "forest")
    plain.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data").schema["nodeData"].dataType
    turned = nodes.groupBy("tree").applyInArrow(_library_nodes(cuts, settings.classes), SAVED)
    split = [F.col(c) if c != "split" else F.struct(*saved["split"].dataType.names).alias("split") for c in saved.names]
    turned.select("treeID", F.struct(*split).cast(saved).alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    kind = RandomForestClassificationModel if settings.classes else RandomForestRegressionModel
    model = kind.load(path)
    discard(spark, path)
    return model


def fit_grown(rows: DataFrame, features: list[str], label: Column, weight: Column, learner: Learner):
    """The library's forest model of ``learner``'s settings; classes are 0 and 1.

    ``rows`` should be a written table. Missing features, labels or weights raise, as in the library.
    """
    spark = rows.sparkSession
    ship(spark)
    bins = learner.getMaxBins()
    if bins > 256 or learner.getSubsamplingRate() != 1.0:
        raise ValueError("at most 256 bins, and bootstraps of the table's size")
    cuts = cuts_of(rows, features, bins)
    settings = _Settings(learner, len(features), bins)
    numbers = rows.select(label.cast("double").alias("y"), weight.cast("double").alias("w"), *[F.col(f).cast("double") for f in features])
    coded, path = stage_path(map_batches(numbers, _pack(cuts), CODED), "forest-coded")
    total = coded.agg(F.sum("n")).first()[0]
    wave = max(1, int(WAVE_BYTES / (total * HELD * (len(features) + 17))))
    waves = [_wave(coded, total, range(t, min(t + wave, settings.trees)), settings) for t in range(0, settings.trees, wave)]
    nodes = waves[0][0]
    for more, _ in waves[1:]:
        nodes = nodes.unionByName(more)
    model = _as_model(nodes, cuts, learner, settings)
    discard(spark, path, *[p for _, p in waves])
    return model
