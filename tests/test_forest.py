"""Forests as node tables: against a plain tree, against the library's models, and odd tables."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from basketlens.operators import forest as module
from basketlens.operators.forest import grow_forest, library_forest
from basketlens.plans.train import churn_probability, fit_churn_forest

FEATURES = ["a", "b", "c", "d"]
ROWS = "key long, y long, a double, b double, c double, d double"


def table(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 9, n).astype(float), rng.exponential(size=n)
    y = ((a + 0.4 * b + 0.3 * rng.normal(size=n)) > 1.5).astype(int)
    rows = [
        (int(i), None if i % 97 == 0 else int(y[i]), None if i % 11 == 0 else float(a[i]), float(b[i]), float(c[i]), 5.0) for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, ROWS).repartition(5)


def plain_tree(rows, cuts, depth, least):
    """(node -> feature, cut, n, total) of one tree without a bootstrap, every cut tried."""
    coded = [
        (y, [0 if v is None else sum(c < v for c in own) for v, own in zip(values, cuts, strict=True)]) for _, y, *values in rows if y is not None
    ]
    nodes, todo = {}, [(1, coded, 0)]
    while todo:
        node, own, level = todo.pop()
        best, g, w = (0.0, 0, 0), float(sum(y for y, _ in own)), float(len(own))
        for f in range(len(cuts)):
            for cut in range(len(cuts[f])):
                left = [y for y, x in own if x[f] <= cut]
                wl, gl = float(len(left)), float(sum(left))
                if level < depth and wl >= least and w - wl >= least:
                    gain = gl * gl / wl + (g - gl) * (g - gl) / (w - wl) - g * g / w
                    if gain > best[0]:
                        best = (gain, f, cut)
        if best[0] <= 0:
            nodes[node] = (-1, -1, len(own), g)
            continue
        _, f, cut = best
        nodes[node] = (f, cut, len(own), g)
        for child, side in ((2 * node, False), (2 * node + 1, True)):
            todo.append((child, [r for r in own if (r[1][f] > cut) == side], level + 1))
    return nodes


@pytest.mark.parametrize("cells", [2_000_000, 40])
def test_a_tree_matches_a_plain_one(spark, monkeypatch, cells):
    monkeypatch.setattr(module, "CELLS", cells)
    rows, df = table(spark)
    got = grow_forest(df, "key", "y", FEATURES, trees=1, depth=4, bins=10, least=7)
    assert got.cuts[3] == (5.0,)
    want = plain_tree(rows, got.cuts, 4, 7)
    assert {n: (v[0], v[1], v[3], v[4]) for (_, n), v in got.nodes.items()} == want
    scored = got.predict(df, ("key",))
    mean = {r["key"]: r["prediction"] for r in scored.collect()}
    for key, _, *values in rows:
        node = 1
        while want[node][0] >= 0:
            f, cut = want[node][:2]
            node = 2 * node + (values[f] is not None and values[f] > got.cuts[f][cut])
        assert mean[key] == want[node][3] / want[node][2]


def test_partitions_play_no_part_and_one_scan_serves_all_trees(spark):
    _, df = table(spark)
    first, second = (grow_forest(df.repartition(n), "key", "y", FEATURES, trees=6, depth=3, tried=2) for n in (1, 6))
    assert first.nodes == second.nodes and len({n for t, n in first.nodes if n == 1}) == 1
    assert len({tuple(v[:2] for (t, _), v in sorted(first.nodes.items()) if t == tree) for tree in range(6)}) > 1
    shares = first.importances()
    assert np.isclose(sum(shares.values()), 1) and shares["d"] == 0 and shares["a"] > shares["c"]


def test_a_forest_ranks_better_than_chance_on_rows_it_has_not_seen(spark):
    _, df = table(spark, 1500)
    grown = grow_forest(df.where("key % 3 > 0"), "key", "y", FEATURES, trees=15, depth=5, tried=2)
    held = grown.predict(df.where("key % 3 = 0 and y is not null"), ("y",), "p").toPandas()
    ones, zeros = held.p[held.y == 1].to_numpy(), held.p[held.y == 0].to_numpy()
    assert (ones[:, None] > zeros[None, :]).mean() > 0.9


def test_tables_without_a_choice(spark):
    empty = spark.createDataFrame([], ROWS)
    grown = grow_forest(empty, "key", "y", FEATURES, trees=2, depth=3)
    assert grown.predict(empty, ("key",)).count() == 0 and set(grown.nodes) == {(0, 1), (1, 1)}
    same = spark.createDataFrame([(i, 1, 1.0, 2.0, None, 3.0) for i in range(20)], ROWS)
    grown = grow_forest(same, "key", "y", FEATURES, trees=1, depth=3)
    assert grown.nodes == {(0, 1): (-1, -1, 0.0, 20, 20.0, 0.0)} and set(grown.importances().values()) == {0.0}
    assert {r["prediction"] for r in grown.predict(same, ("key",)).collect()} == {1.0}


def test_node_tables_of_the_library_score_alike(spark):
    _, df = table(spark)
    rows = df.where("y is not null").select("key", F.col("y").cast("int").alias("Churn"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES])
    model = fit_churn_forest(rows, FEATURES, trees=7, depth=5)
    nodes = library_forest(model, FEATURES, spark)
    both = nodes.predict(rows, ("key",), "p").join(churn_probability(rows, model, ("key",)), "key").collect()
    assert max(abs(r["p"] - r["churn_probability"]) for r in both) < 1e-12
    own = model.stages[-1].featureImportances.toArray()
    assert np.allclose([nodes.importances()[f] for f in FEATURES], own)
    forest = RandomForestRegressor(numTrees=5, maxDepth=4, labelCol="c", predictionCol="spend", seed=2)
    fitted = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), forest]).fit(rows)
    nodes = library_forest(fitted, ["a", "b"], spark)
    both = nodes.predict(rows, ("key",), "p").join(fitted.transform(rows).select("key", "spend"), "key").collect()
    assert max(abs(r["p"] - r["spend"]) for r in both) < 1e-9
