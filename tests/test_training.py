"""Models are fitted when a job asks for them, and short tables of forests get more tasks."""

from types import SimpleNamespace

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from basketlens.operators.scaling import Scaler
from basketlens.plans import train
from basketlens.plans.prepare import Preparation, Prepared
from basketlens.plans.train import FOREST_TASKS, SPEND_MEMORY, Training, _vectors, fit_churn_forest, fit_spend, gathered, widened
from basketlens.sources.artefacts import MODEL_NAMES, PREPARATION_NAMES, bundle_of


def test_a_bundle_fits_only_what_is_asked_for():
    """Nothing but components and segments exists, and nothing else is fitted for them."""
    training = Training.__new__(Training)
    preparation = SimpleNamespace(name="preparation")
    vars(training).update(
        prepared=SimpleNamespace(preparation=preparation), components="pca", segmentation=SimpleNamespace(model="kmeans"), forest="forest"
    )
    bundle = bundle_of(training)
    assert {*bundle.models} == {*MODEL_NAMES} and {*bundle.preparations} == {*PREPARATION_NAMES}
    assert bundle.models["pca"] == "pca" and bundle.models["kmeans"] == "kmeans" and bundle.preparations["preparation"] is preparation
    assert training.churn_models["random_forest"] == "forest"
    assert {"boosting", "spend", "champion"}.isdisjoint(vars(training))


def test_short_tables_of_forests_get_more_tasks_and_keep_their_partitions(spark):
    short, long = spark.range(2000).coalesce(1), spark.range(20_000).coalesce(1)
    assert widened(short).rdd.getNumPartitions() == 1
    parts = widened(long).rdd.glom().collect()
    assert len(parts) == FOREST_TASKS and not any(parts[1:])
    assert [r["id"] for r in parts[0]] == list(range(20_000))


def test_more_tasks_leave_a_forest_as_it_is(spark):
    rows = spark.range(6000).select(F.pmod(F.xxhash64("id"), F.lit(997)).cast("double").alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(89)).cast("double").alias("b"))
    rows = rows.withColumn("Churn", (F.col("a") + 5 * F.col("b") > 700).cast("int")).coalesce(1)
    model = fit_churn_forest(rows, ["a", "b"], trees=5, depth=5, balanced=False)
    plain = RandomForestClassifier(numTrees=5, maxDepth=5, minInstancesPerNode=5, maxBins=64, seed=42, weightCol="weight")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(_vectors(rows, ["a", "b"], "Churn", False))
    assert model.stages[-1].toDebugString.split("\n")[1:] == plain.fit(vectors).toDebugString.split("\n")[1:]


def test_memory_for_more_nodes_a_pass_leaves_the_spend_trees_as_they_are(spark, monkeypatch):
    rows = spark.range(3000).select(
        F.col("id").alias("CustomerID"), F.lit("train").alias("split"), F.lit(0).alias("Churn"),
        *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(m)).cast("double").alias(f"x{i}") for i, m in enumerate((97, 89, 13))],
    ).withColumn("MonetaryTotal", 3 * F.col("x0") + F.col("x1") * F.col("x2"))
    prepared = Prepared(rows.coalesce(1), None, None, None, Preparation((), None, (), None, {}, (), Scaler((), (), ())))
    grown = []
    for memory in (SPEND_MEMORY, 1):
        monkeypatch.setattr(train, "SPEND_MEMORY", memory)
        forest = fit_spend(prepared, trees=6, depth=6).model.stages[-1]
        assert forest.getOrDefault("maxMemoryInMB") == memory
        grown.append(forest.toDebugString.split("\n")[1:])
    assert grown[0] == grown[1]
    assert SPEND_MEMORY > 256


def test_tables_that_have_the_cluster_to_themselves_are_read_by_more_tasks(spark):
    """Long tables by their rows, tables of a few tasks by more, short ones by one as before."""
    tasks = [gathered(spark.range(0, rows, 1, 16)).rdd.getNumPartitions() for rows in (100, 19_999, 113_000, 590_000, 700_000)]
    assert tasks == [1, 1, 11, 12, 14]
