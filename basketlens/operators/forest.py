"""Forests grown by counting, kept as a table of nodes.

Feature values are coded by their place between quantile cuts. A level of all trees is one
scan: every task sums weights and targets per (tree, node, feature, code), Spark adds them
up, and the best cut of each node comes from running sums over the codes. Targets are whole
numbers (classes 0 and 1, amounts in cents), so sums are exact, ties are real ties, and the
trees do not depend on partitions. Bootstrap weights and the features that a node tries are
draws of (tree, row) and (tree, node, feature).

A forest is its node table (tree, node, feature, cut, threshold, n, total, gain): the
children of node i are 2i and 2i + 1, and importances and predictions are sums over it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketlens.functions.hashing import uniform
from basketlens.operators.quantiles import exact_quantiles
from basketlens.shipping import map_batches
from basketlens.staging import discard, new_path, stage

#: Cumulated shares of rows that a bootstrap of the table's size draws 0, 1, 2 and 3 times; the rest counts 4.
DRAWN = (0.367879, 0.735759, 0.919699, 0.981012)
#: Sums of a level held by a task; wider levels take several scans.
CELLS = 2_000_000
NODES = "tree int, node long, feature int, cut int, threshold double, n long, total double, gain double"


def bootstrap_weight(draw: Column) -> Column:
    """How often a row counts, from a number in [0, 1)."""
    weight = F.when(draw < DRAWN[0], 0)
    for times, share in enumerate(DRAWN[1:], 1):
        weight = weight.when(draw < share, times)
    return weight.otherwise(len(DRAWN))


def feature_cuts(rows: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Ascending cuts of every feature at its quantiles, to six places; a constant feature has one."""
    found = exact_quantiles(rows, features, [i / bins for i in range(1, bins)])
    return [sorted({round(float(v), 6) for v in found[f].values() if v is not None}) for f in features]


def codes(features: list[str], cuts: list[list[float]]) -> Column:
    """Number of a feature's cuts below its value, as an array; a missing value counts as below all."""

    def below(feature: str, own: list[float]) -> Column:
        value = F.col(feature).cast("double")
        return F.coalesce(F.size(F.filter(F.lit(own or [0.0]), lambda c: c < value)), F.lit(0)).cast("int")

    return F.array(*[below(f, own) for f, own in zip(features, cuts, strict=True)])


def tried_features(tree: int, node: int, features: int, tried: int, seed: int) -> list[int]:
    """The features that a node tries: those with the smallest draws."""
    if tried >= features:
        return list(range(features))
    draws = [(xor_draw(seed, tree, node, f), f) for f in range(features)]
    return sorted(f for _, f in sorted(draws)[:tried])


def xor_draw(seed: int, tree: int, node: int, feature: int) -> int:
    """A number that SQL can state: multiplication and remainder only."""
    return ((tree + 1) * 7919 + node * 104_729 + (feature + 1) * 1_299_709 + seed) * 48_271 % 2_147_483_647


@dataclass(frozen=True)
class Forest:
    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    trees: int
    nodes: dict[tuple[int, int], tuple[int, int, float, int, float, float]]  # (tree, node) -> feature (-1: leaf), cut, threshold, n, total, gain

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, n, *values) for (t, n), values in sorted(self.nodes.items())]
        return spark.createDataFrame(rows, NODES)

    def importances(self) -> dict[str, float]:
        """Gain per feature as a share of its tree's, averaged over the trees that split."""
        shares = np.zeros(len(self.features))
        for t in range(self.trees):
            own = np.zeros(len(self.features))
            for (tree, _), (feature, _, _, _, _, gain) in self.nodes.items():
                if tree == t and feature >= 0:
                    own[feature] += gain
            if own.sum() > 0:
                shares += own / own.sum()
        total = shares.sum()
        return dict(zip(self.features, (shares / total if total > 0 else shares).tolist(), strict=True))

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Per tree the nodes' numbers, features, thresholds, children's places and means, for scoring."""
        place = {key: i for i, key in enumerate(sorted(self.nodes))}
        feature, threshold, left, right, mean = (np.zeros(len(place), dtype=k) for k in (np.int64, float, np.int64, np.int64, float))
        for (t, n), i in place.items():
            f, _, value, size, total, _ = self.nodes[t, n]
            feature[i], threshold[i], mean[i] = f, value, total / size if size else 0.0
            left[i], right[i] = place.get((t, 2 * n), i), place.get((t, 2 * n + 1), i)
        return np.array([place[t, 1] for t in range(self.trees)]), feature, threshold, left, right, mean

    def predict(self, df: DataFrame, keep: tuple[str, ...], name: str = "prediction") -> DataFrame:
        """``keep`` and the mean over the trees of the mean target in the row's leaf.

        A value goes left where it is missing or at most the threshold.
        """
        roots, feature, threshold, left, right, mean = self.arrays()

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                total = np.zeros(len(x))
                for root in roots:
                    at = np.full(len(x), root)
                    moving = np.arange(len(x)) if feature[root] >= 0 else np.array([], dtype=np.int64)
                    while len(moving):
                        here = at[moving]
                        value = x[moving, feature[here]]
                        at[moving] = np.where(value > threshold[here], right[here], left[here])
                        moving = moving[feature[at[moving]] >= 0]
                    total += mean[at]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(total / len(roots))], names=[*batch.schema.names[:-1], name]
                )

        rows = df.select(*keep, F.array(*[F.col(f).cast("double") for f in self.features]).alias("_x"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
        return map_batches(rows, run, f"{kinds}, {name} double")


def _level(table: DataFrame, asked: dict[tuple[int, int], list[int]], splits: dict, width: int) -> DataFrame:
    """(tree, node, feature, code, n, total) of the rows in the asked nodes, for the features they try; one scan."""
    trees = sorted({t for t, _ in asked})
    place = {key: i for i, key in enumerate(sorted(asked))}
    offsets = np.cumsum([0] + [len(asked[key]) for key in sorted(asked)])

    def run(batches):
        n = np.zeros(offsets[-1] * width, dtype=np.int64)
        total = np.zeros(offsets[-1] * width)
        for batch in batches:
            if not batch.num_rows:
                continue
            target = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            code = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            weight = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            for t in trees:
                rows = np.flatnonzero(weight[:, t] > 0)
                node = np.ones(len(rows), dtype=np.int64)
                # Down the splits known so far, a level at a time.
                while True:
                    known = np.zeros(len(rows), dtype=bool)
                    for at in np.unique(node).tolist():
                        if (t, at) in splits and (t, at) not in asked:
                            feature, cut = splits[t, at]
                            here = np.flatnonzero(node == at)
                            node[here] = 2 * at + (code[rows[here], feature] > cut)
                            known[here] = True
                    if not known.any():
                        break
                for at in np.unique(node).tolist():
                    if (t, at) not in asked:
                        continue
                    own = rows[node == at]
                    w, wy = weight[own, t].astype(np.int64), weight[own, t] * target[own]
                    for k, feature in enumerate(asked[t, at]):
                        start = (offsets[place[t, at]] + k) * width
                        n[start : start + width] += np.bincount(code[own, feature], weights=w, minlength=width).astype(np.int64)
                        total[start : start + width] += np.bincount(code[own, feature], weights=wy, minlength=width)
        filled = np.flatnonzero(n)
        slot, value = np.divmod(filled, width)
        which = np.searchsorted(offsets, slot, side="right") - 1
        keys = sorted(asked)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array([keys[i][0] for i in which], dtype=np.int32)),
                pa.array(np.array([keys[i][1] for i in which], dtype=np.int64)),
                pa.array(np.array([asked[keys[i]][s - offsets[i]] for i, s in zip(which, slot)], dtype=np.int32)),
                pa.array(value.astype(np.int32)),
                pa.array(n[filled]),
                pa.array(total[filled]),
            ],
            names=["tree", "node", "feature", "code", "n", "total"],
        )

    parts = map_batches(table, run, "tree int, node long, feature int, code int, n long, total double")
    return parts.groupBy("tree", "node", "feature", "code").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _best(counts: DataFrame, least: int) -> list:
    """For every node its size and sum, and the cut with the largest gain: (feature, cut, gain), the first of equal ones."""
    whole = Window.partitionBy("tree", "node", "feature")
    upto = whole.orderBy("code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counts.select(
        "tree", "node", "feature", "code",
        F.sum("n").over(whole).cast("double").alias("w"), F.sum("total").over(whole).alias("g"),
        F.sum("n").over(upto).cast("double").alias("wl"), F.sum("total").over(upto).alias("gl"),
    )
    wl, gl, wr, gr = F.col("wl"), F.col("gl"), F.col("w") - F.col("wl"), F.col("g") - F.col("gl")
    gain = F.when((wl >= least) & (wr >= least), gl * gl / wl + gr * gr / wr - F.col("g") * F.col("g") / F.col("w"))
    ranked = F.max(F.when(gain > 0, F.struct(gain.alias("gain"), -F.col("feature"), -F.col("code")))).alias("best")
    return sums.groupBy("tree", "node").agg(F.first("w").alias("w"), F.first("g").alias("g"), ranked).collect()


def grow_forest(
    rows: DataFrame,
    key: str,
    target: str,
    features: list[str],
    trees: int = 20,
    depth: int = 5,
    bins: int = 32,
    least: int = 5,
    tried: int | None = None,
    seed: int = 42,
) -> Forest:
    """A forest of means of ``target`` (whole numbers), cut where the squared deviation falls most.

    For classes 0 and 1 that is Gini's criterion, and the mean is the share of ones. ``tried``
    features are tried at a node (all by default). Children hold at least ``least`` draws. Rows
    without a target are left out; missing features count as smallest. A forest needs one scan
    per level (more when its sums exceed ``CELLS``) and keeps the nodes alone on the driver.
    """
    cuts = feature_cuts(rows, features, bins)
    draws = [bootstrap_weight(uniform(f"tree{seed}", F.lit(t), F.col(key))) if trees > 1 else F.lit(1) for t in range(trees)]
    table = stage(
        rows.where(F.col(target).isNotNull()).select(
            F.col(target).cast("long").alias("y"), codes(features, cuts).alias("codes"), F.array(*[d.cast("int") for d in draws]).alias("weights")
        ),
        "coded",
    )
    tried = tried or len(features)
    width = 1 + max(len(c) for c in cuts)
    nodes, splits = {}, {}
    open_nodes = [(t, 1) for t in range(trees)]
    for level in range(depth + 1):
        asked = {(t, n): tried_features(t, n, len(features), tried if level < depth else 1, seed) for t, n in open_nodes}
        open_nodes = []
        step = max(1, CELLS // (width * max(map(len, asked.values()), default=1)))
        keys = sorted(asked)
        for start in range(0, len(keys), step):
            part = {k: asked[k] for k in keys[start : start + step]}
            for r in _best(_level(table, part, splits, width), least):
                size, total = int(r["w"]), r["g"]
                if r["best"] is None or level == depth:
                    nodes[r["tree"], r["node"]] = (-1, -1, 0.0, size, total, 0.0)
                    continue
                gain, feature, cut = r["best"][0], -r["best"][1], -r["best"][2]
                nodes[r["tree"], r["node"]] = (feature, cut, float(cuts[feature][cut]), size, total, gain)
                splits[r["tree"], r["node"]] = (feature, cut)
                open_nodes += [(r["tree"], 2 * r["node"]), (r["tree"], 2 * r["node"] + 1)]
        if not open_nodes:
            break
    for t in range(trees):
        nodes.setdefault((t, 1), (-1, -1, 0.0, 0, 0.0, 0.0))
    return Forest(tuple(features), tuple(tuple(c) for c in cuts), trees, nodes)


def library_forest(model: PipelineModel, features: list[str], spark: SparkSession) -> Forest:
    """The node table of a fitted forest of the ML library, from its saved form: the same scores and importances."""
    forest = model.stages[-1]
    path = new_path(spark, "forest")
    forest.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    discard(spark, path)
    classes = hasattr(forest, "numClasses")
    by_id = {(r["treeID"], r["id"]): r for r in saved}
    nodes = {}
    todo = [(t, 0, 1) for t in {r["treeID"] for r in saved}]
    while todo:
        tree, at, number = todo.pop()
        r = by_id[tree, at]
        stats = r["impurityStats"]
        weight = sum(stats) if classes else stats[0]
        mean = stats[1] / weight if classes and weight else r["prediction"]
        inner = r["leftChild"] >= 0
        feature = r["split"]["featureIndex"] if inner else -1
        value = r["split"]["leftCategoriesOrThreshold"][0] if inner else 0.0
        # A total that gives the leaf's mean back; the gain is weighted by the node's rows, as importances are.
        nodes[tree, number] = (feature, -1, value, 1, mean, r["gain"] * weight if inner else 0.0)
        if inner:
            todo += [(tree, r["leftChild"], 2 * number), (tree, r["rightChild"], 2 * number + 1)]
    return Forest(tuple(features), (), 1 + max(t for t, _ in nodes), nodes)
