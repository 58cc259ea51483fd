"""Forests of long tables are grown in arrays, by the library's rules."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from basketlens.operators import grown
from basketlens.operators.evaluate import roc_auc
from basketlens.operators.grown import chosen_cuts, fit_grown
from basketlens.plans import train
from basketlens.plans.train import churn_probability, fit_churn_forest

FEATURES = ["a", "b", "c", "d"]


def rows_of(spark, n=6000, wide=False):
    """Whole-number features, of at most 64 values unless ``wide``; a class and an amount that depend on them."""
    sizes = (997, 61, 31, 5) if wide else (53, 61, 31, 5)
    rows = spark.range(0, n, 1, 3).select("id", *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(m)).cast("double").alias(f) for i, (f, m) in enumerate(zip(FEATURES, sizes))])
    noise = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(40))
    return rows.withColumn("y", (F.col("a") + F.col("b") + noise > 75).cast("double")).withColumn(
        "spend", F.col("a") * 3 + F.when(F.col("b") > 20, F.col("c") * 7).otherwise(0) + noise
    )


def vectors(rows):
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def trees_of(model):
    """The trees' text, numbers to six places."""
    return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.6f}", model.toDebugString).split("\n")[1:]


@pytest.mark.parametrize("kind, label", [(RandomForestClassifier, "y"), (RandomForestRegressor, "spend")])
def test_trees_without_draws_are_the_librarys(spark, kind, label):
    """Same cuts, nodes, leaves put together, statistics and importances, where nothing is drawn."""
    rows = rows_of(spark)
    learner = kind(numTrees=2, maxDepth=6, minInstancesPerNode=5, maxBins=64, featureSubsetStrategy="all", bootstrap=False, seed=1, labelCol=label)
    own, plain = fit_grown(rows, FEATURES, F.col(label), F.lit(1.0), learner), learner.fit(vectors(rows))
    assert trees_of(own) == trees_of(plain)
    assert np.allclose(own.featureImportances.toArray(), plain.featureImportances.toArray())
    shown = [c for c in ("rawPrediction", "probability", "prediction") if c in own.transform(vectors(rows)).columns]
    both = [model.transform(vectors(rows)).orderBy("id").select(*shown).collect() for model in (own, plain)]
    flat = [np.array([[v for x in r for v in (x.toArray() if hasattr(x, "toArray") else [x])] for r in side]) for side in both]
    assert np.allclose(*flat)


def test_trees_do_not_depend_on_where_a_node_is_grown(spark, monkeypatch):
    """Nodes cut by all tasks, waves of few trees and other partitions give the trees of nodes grown whole."""
    rows = rows_of(spark, wide=True)
    learner = RandomForestClassifier(numTrees=6, maxDepth=7, minInstancesPerNode=5, maxBins=64, seed=3, labelCol="y", weightCol="weight")
    weight = F.when(F.col("y") == 1, 0.5).otherwise(2.0)
    whole = trees_of(fit_grown(rows, FEATURES, F.col("y"), weight, learner))
    monkeypatch.setattr(grown, "NODE_ROWS", 700)
    monkeypatch.setattr(grown, "WAVE_BYTES", 200_000)
    monkeypatch.setattr(grown, "DEALT_BYTES", 1000)
    assert trees_of(fit_grown(rows, FEATURES, F.col("y"), weight, learner)) == whole
    assert len({*whole}) > 50


def test_drawn_forests_are_as_good_as_the_librarys(spark):
    rows, test = rows_of(spark, 12_000, wide=True), rows_of(spark, 15_000, wide=True).where("id >= 12000")
    learner = RandomForestClassifier(numTrees=20, maxDepth=6, minInstancesPerNode=5, maxBins=64, seed=3, labelCol="y", weightCol="weight")
    weighted = rows.withColumn("weight", F.lit(1.0))
    found = []
    for model in (fit_grown(rows, FEATURES, F.col("y"), F.lit(1.0), learner), learner.fit(vectors(weighted))):
        scored = model.transform(vectors(test)).select("y", F.udf(lambda v: float(v[1]), "double")("probability").alias("p"))
        found.append((roc_auc(scored, "y", "p").first()["auc"], model.totalNumNodes))
    assert abs(found[0][0] - found[1][0]) < 0.01 and found[0][0] > 0.8
    assert 0.85 < found[0][1] / found[1][1] < 1.15


def test_long_tables_do_not_reach_the_librarys_learner(spark, monkeypatch):
    """Its dense histograms a node and partition were what a long table's fit took."""
    fitted = []
    plain = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, rows: fitted.append(rows.count()) or plain(self, rows))
    monkeypatch.setattr(train, "GROWN_ROWS", 5000)
    for n in (4000, 6000):
        rows = rows_of(spark, n).withColumn("Churn", F.col("y").cast("int"))
        model = fit_churn_forest(rows, FEATURES, trees=5, depth=4)
        assert churn_probability(rows, model, ("id",)).count() == n
    assert fitted == [4000, 2]


def test_missing_values_are_refused(spark):
    learner = RandomForestClassifier(numTrees=2, labelCol="y")
    for bad in ("a", "y"):
        rows = rows_of(spark, 200).withColumn(bad, F.when(F.col("id") != 7, F.col(bad)))
        with pytest.raises(Exception, match="missing"):
            fit_grown(rows, FEATURES, F.col("y"), F.lit(1.0), learner)


def test_cuts_of_values_with_many_rows():
    assert chosen_cuts(np.array([1.0, 2.0, 4.0]), np.array([5.0, 1.0, 1.0]), 3) == [1.5, 3.0]
    assert chosen_cuts(np.array([3.0]), np.array([9.0]), 4) == []
    # Half of the rows share a value: the next values get the cuts that it leaves over.
    values, counts = np.arange(11.0), np.array([100.0, *[10.0] * 10])
    assert chosen_cuts(values, counts, 5) == [0.5, 1.5, 2.5, 6.5]
