"""Training jobs: components, segments, churn classifiers and the spend regressor."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import cached_property
from math import ceil

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.operators.clustering import best_k
from basketlens.operators.evaluate import roc_auc
from basketlens.operators.grown import Learner, fit_grown
from basketlens.operators.kmeans import kmeans_sweep
from basketlens.operators.scaling import fill_medians, fit_scaler, impute, train_medians, with_class_weight
from basketlens.operators.select import regression_inputs
from basketlens.operators.split import random_split, stratified_split
from basketlens.plans.prepare import Preparation, Prepared
from basketlens.sources.customers import KEY, TARGET
from basketlens.staging import enable_checkpoints, stage


def fit_components(train: DataFrame, features: list[str], share: float = 0.95) -> PipelineModel:
    """Centre, rotate, keep the first components whose cumulated variance exceeds ``share``.

    All components are fitted at once (a features x features matrix on the driver)
    and the surplus ones are sliced off, so one pass over the rows is enough.
    """
    fitted = Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="features"),
            StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False),
            PCA(k=len(features), inputCol="centred", outputCol="components"),
        ]
    ).fit(train)
    cumulated = np.cumsum(fitted.stages[-1].explainedVariance.toArray())
    kept = min(int(np.searchsorted(cumulated, share, side="right")) + 1, len(features))
    cut = VectorSlicer(inputCol="components", outputCol="pca", indices=list(range(kept)))
    return PipelineModel(stages=[*fitted.stages, cut])


def variance_curve(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(component, share, cumulative, kept)."""
    shares = model.stages[2].explainedVariance.toArray()
    kept = len(model.stages[3].getIndices())
    rows = [
        (i + 1, float(s), float(c), i < kept) for i, (s, c) in enumerate(zip(shares, np.cumsum(shares)))
    ]
    return spark.createDataFrame(rows, "component int, share double, cumulative double, kept boolean")


def variance_kept(curve: DataFrame) -> DataFrame:
    return curve.where("kept").agg(
        F.count("*").alias("components"), F.bround(F.sum("share") * 100, 2).alias("variance_percent")
    )


def rotated(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with their component scores as an array column ``pca``."""
    scored = model.transform(df).withColumn("pca", vector_to_array("pca"))
    return scored.drop("features", "centred", "components")


def projection(df: DataFrame, model: PipelineModel, keep: tuple[str, ...]) -> DataFrame:
    """First two components of every row."""
    both = vector_to_array("components")
    return model.transform(df).select(*keep, both[0].alias("pc1"), both[1].alias("pc2"))


def segment_model(spark: SparkSession, centres: np.ndarray, column: str = "pca") -> KMeansModel:
    """A model with these centres: with as many clusters as distinct points, a fit keeps the points."""
    distinct = np.unique(centres, axis=0)
    points = spark.createDataFrame([(Vectors.dense(c),) for c in distinct], [column])
    return KMeans(k=len(distinct), initMode="random", maxIter=1, seed=1, featuresCol=column, predictionCol="cluster").fit(points)


def _arrays(vectors: DataFrame, column: str) -> DataFrame:
    keys = [c for c in vectors.columns if c != column]
    return vectors.select(F.concat_ws("|", *[F.col(c).cast("string") for c in keys]).alias("row"), vector_to_array(column).alias("x"))


def fit_segments(vectors: DataFrame, k: int, restarts: int = 10, seed: int = 42, column: str = "pca") -> KMeansModel:
    """K-Means with the lowest inertia of ``restarts`` starts; the other columns of ``vectors`` name the row."""
    sweep = kmeans_sweep(_arrays(vectors, column), "row", F.col("x"), range(k, k + 1), restarts, seed, score=False)
    return segment_model(vectors.sparkSession, sweep.best(k).centres, column)


@dataclass(frozen=True)
class Segmentation:
    scores: DataFrame  # (k, inertia, silhouette)
    best_k: int
    model: KMeansModel


#: Rows a task of an iterative fit should have; smaller tables are read by fewer tasks.
ROWS_PER_TASK = 50_000
#: A table of less than so many of those tasks is read by up to as many, with this many rows each: its fits have the cluster to themselves.
SHORT_TASKS, SHORT_ROWS = 12, 10_000
#: A sweep weighs every row against all centres in every round: a short table is dealt over the cores, this many rows to a task at least.
SWEEP_ROWS = 4_000
#: Fits that are submitted side by side; each is a chain of small jobs.
SIDE_BY_SIDE = 6
#: A forest's cuts are weighed by as many tasks as its table has partitions: so many for short tables, one for this many rows.
FOREST_TASKS, FOREST_ROWS = 8, 2_500
#: Forests of tables with so many rows are grown in arrays, shorter ones by the library.
GROWN_ROWS = 10_000
#: MB that a task's sums may take in the spend forest, whose nodes try every feature: fewer passes for a level, the same trees.
SPEND_MEMORY = 1024


def gathered(df: DataFrame) -> DataFrame:
    """A written table in as many partitions as its rows call for, for fits that scan it many times."""
    rows = df.count()
    return df.coalesce(max(1, ceil(rows / ROWS_PER_TASK), min(SHORT_TASKS, rows // SHORT_ROWS)))


def dealt(df: DataFrame) -> DataFrame:
    """A written table as ``gathered``, but a short one over as many tasks as the session runs at a time."""
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, ceil(rows / ROWS_PER_TASK), min(cores, rows // SWEEP_ROWS))
    return df.repartition(tasks) if tasks > df.rdd.getNumPartitions() else df.coalesce(tasks)


def widened(df: DataFrame) -> DataFrame:
    """A forest's short table with empty partitions behind its own, so that more tasks weigh the cuts.

    The rows keep their partitions, as a forest's bootstrap draws depend on them.
    """
    missing = min(FOREST_TASKS, ceil(df.count() / FOREST_ROWS)) - df.rdd.getNumPartitions()
    if missing <= 0:
        return df
    spark = df.sparkSession
    return df.union(spark.createDataFrame(spark.sparkContext.parallelize([], missing), df.schema))


def side_by_side(tasks: list[Callable]) -> list:
    """Results of independent fits, submitted from a few driver threads."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def sweep_segments(vectors: DataFrame, ks: range = range(2, 9), restarts: int = 10, seed: int = 42, column: str = "pca") -> Segmentation:
    """Inertia and silhouette of all rows per k; the model of the best silhouette.

    The starts of every k go forward together: a round is one scan of the packed rows.
    The other columns of ``vectors`` name the row.
    """
    sweep = kmeans_sweep(dealt(stage(_arrays(vectors, column), "points")), "row", F.col("x"), ks, restarts, seed)
    spark = vectors.sparkSession
    scores = spark.createDataFrame(sweep.scores, "k int, inertia double, silhouette double")
    chosen = best_k(scores).first()["k"]
    return Segmentation(scores, chosen, segment_model(spark, sweep.best(chosen).centres, column))


def _vectors(df: DataFrame, features: list[str], label: str, weight: bool) -> DataFrame:
    table = with_class_weight(df, label) if weight else df.withColumn("weight", F.lit(1.0))
    return table.select(F.col(label).cast("double").alias("label"), "weight", *features)


def _fit_forest(rows: DataFrame, features: list[str], forest: Learner, label: str, weight: str | None = None) -> PipelineModel:
    """The forest over ``features``; long tables are grown in arrays, by the same rules and with other draws than the library's."""
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    fits = F.col(label).isin(0, 1) if isinstance(forest, RandomForestClassifier) else F.col(label).isNotNull()
    found = rows.agg(F.count("*").alias("rows"), F.count_if(fits).alias("fit")).first()
    if found["rows"] < GROWN_ROWS or found["fit"] < found["rows"]:
        return Pipeline(stages=[assembler, forest]).fit(widened(rows))
    model = fit_grown(rows, features, F.col(label), F.col(weight) if weight else F.lit(1.0), forest)
    return PipelineModel(stages=[assembler, model])


def fit_churn_forest(
    train: DataFrame, features: list[str], label: str = TARGET, trees: int = 200, depth: int = 10, seed: int = 42,
    balanced: bool = True,
) -> PipelineModel:
    enable_checkpoints(train.sparkSession)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=5, maxBins=64, seed=seed, weightCol="weight", cacheNodeIds=True
    )
    return _fit_forest(_vectors(train, features, label, balanced), features, forest, "label", "weight")


def fit_churn_boosting(
    train: DataFrame, features: list[str], label: str = TARGET, rounds: int = 200, depth: int = 5, seed: int = 42
) -> PipelineModel:
    enable_checkpoints(train.sparkSession)
    # Shallow trees: a row is passed down from the root faster than its node is written down per level.
    boosting = GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=0.05, subsamplingRate=0.8, maxBins=64, seed=seed
    )
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    return Pipeline(stages=[assembler, boosting]).fit(_vectors(train, features, label, False))


def churn_probability(df: DataFrame, model: PipelineModel, keep: tuple[str, ...]) -> DataFrame:
    """Probability of class 1 and the model's own decision."""
    scored = model.transform(df)
    return scored.select(
        *keep, vector_to_array("probability")[1].alias("churn_probability"), F.col("prediction").cast("int").alias("churn_predicted")
    )


def held_out_auc(model: PipelineModel, rows: DataFrame, label: str = TARGET) -> float | None:
    return roc_auc(churn_probability(rows, model, (label,)), label, "churn_probability").first()["auc"]


def compare_models(models: dict[str, PipelineModel], train: DataFrame, test: DataFrame, label: str = TARGET) -> DataFrame:
    """(model, train_auc, test_auc, gap), in the order given."""
    rows = []
    for name, model in models.items():
        aucs = [held_out_auc(model, side, label) for side in (train, test)]
        rows.append((name, *aucs, None if None in aucs else aucs[0] - aucs[1]))
    return train.sparkSession.createDataFrame(rows, "model string, train_auc double, test_auc double, gap double")


def choose_model(comparison: DataFrame, preferred: str = "random_forest") -> str:
    """Largest AUC; the preferred model on ties."""
    best = comparison.orderBy(F.desc("test_auc"), (F.col("model") != preferred).cast("int")).first()
    return best["model"]


def top_features(spark: SparkSession, model: PipelineModel, features: list[str], n: int = 20) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    )
    return table.orderBy(F.desc("importance"), "feature").limit(n)


@dataclass(frozen=True)
class SpendModel:
    preparation: Preparation
    model: PipelineModel
    test: DataFrame  # key, actual spend, scaled features


def fit_spend(
    prepared: Prepared, key: str = KEY, spend: str = "MonetaryTotal", trees: int = 200, depth: int = 12, seed: int = 42,
    drop_derived: bool = True,
) -> SpendModel:
    """Regressor with its own split, medians and scaler, all kept with the model.

    Rows without a spend have nothing to learn from and are left out. Features
    computed from the spend are excluded unless ``drop_derived`` is off.
    """
    enable_checkpoints(prepared.processed.sparkSession)
    rows = prepared.processed.drop("split").where(F.col(spend).isNotNull())
    table = stage(random_split(rows, key, 0.2, seed), "spend")
    features = [c for c in regression_inputs(table, drop_derived).columns if c not in (key, "split")]
    train, test = (table.where(F.col("split") == side).drop("split") for side in ("train", "test"))
    medians = fill_medians(train, features, train_medians(train, features, test))
    scaler = fit_scaler(impute(train, medians), features)
    ready = [scaler.transform(impute(side, medians).select(key, spend, *features)) for side in (train, test)]
    ready[0] = gathered(stage(ready[0], "spend-train"))
    forest = RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=5, maxBins=64, featureSubsetStrategy="all",
        maxMemoryInMB=SPEND_MEMORY, seed=seed, cacheNodeIds=True, labelCol=spend, predictionCol="monetary_predicted",
    )
    model = _fit_forest(ready[0], features, forest, spend)
    preparation = replace(prepared.preparation, medians=medians, features=tuple(features), scaler=scaler)
    return SpendModel(preparation, model, ready[1])


@dataclass(frozen=True)
class TrainingSizes:
    """Model sizes; the defaults are the full ones."""

    importance_trees: int = 100
    churn_trees: int = 200
    churn_rounds: int = 200
    spend_trees: int = 200
    spend_depth: int = 12
    segments: range = field(default_factory=lambda: range(2, 9))
    restarts: int = 10


class WhenAsked(Mapping):
    """Named results, each made when it is looked up."""

    def __init__(self, makers: dict[str, Callable]) -> None:
        self.makers = makers

    def __getitem__(self, name: str):
        return self.makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


class Training:
    """Every model of one prepared data set, each fitted when first asked for.

    The champion is chosen on a fold held out of the training rows
    (``select_on="test"`` compares on the test side instead).
    """

    def __init__(self, prepared: Prepared, sizes: TrainingSizes = TrainingSizes(), select_on: str = "validation") -> None:
        if select_on not in ("validation", "test"):
            raise ValueError("select_on must be 'validation' or 'test'")
        self.prepared, self.sizes, self.select_on = prepared, sizes, select_on
        self.features = list(prepared.preparation.features)

    @cached_property
    def train(self) -> DataFrame:
        return gathered(stage(self.prepared.train, "train"))

    @cached_property
    def test(self) -> DataFrame:
        return gathered(stage(self.prepared.test, "test"))

    @cached_property
    def components(self) -> PipelineModel:
        return fit_components(self.train, self.features)

    @cached_property
    def segmentation(self) -> Segmentation:
        vectors = stage(self.components.transform(self.train).select(KEY, "copy", "pca"), "components")
        return sweep_segments(vectors, self.sizes.segments, self.sizes.restarts)

    @cached_property
    def forest(self) -> PipelineModel:
        return fit_churn_forest(self.train, self.features, trees=self.sizes.churn_trees)

    @cached_property
    def boosting(self) -> PipelineModel:
        return fit_churn_boosting(self.train, self.features, rounds=self.sizes.churn_rounds)

    @property
    def churn_models(self) -> Mapping[str, PipelineModel]:
        return WhenAsked({"random_forest": lambda: self.forest, "gradient_boosting": lambda: self.boosting})

    @property
    def classifier(self) -> PipelineModel:
        """The champion."""
        self.ready("forest", "boosting", "champion")
        return self.churn_models[self.champion]

    def ready(self, *names: str) -> None:
        """Fit the named ones that are not fitted yet, side by side."""
        # A champion of the test side needs the fitted models; it follows when it is asked for.
        missing = [n for n in names if n not in vars(self) and (n != "champion" or self.select_on == "validation")]
        self.train, self.test  # noqa: B018  written before the fits share them
        side_by_side([lambda n=n: getattr(self, n) for n in missing])

    @cached_property
    def comparison(self) -> DataFrame:
        self.ready("forest", "boosting")
        return compare_models(self.churn_models, self.train, self.test)

    @cached_property
    def champion(self) -> str:
        if self.select_on == "test":
            return choose_model(self.comparison)
        folds = stage(stratified_split(self.train.where("copy = 0"), TARGET, KEY, 0.2, seed=43), "folds")
        held = folds.where("split = 'test'").select(KEY).distinct()
        # A synthetic row stays with its parent, so none of it leaks into the fold.
        inner = gathered(stage(self.train.join(held, KEY, "left_anti"), "fold-train"))
        fold = folds.where("split = 'test'").drop("split")
        trees, rounds = self.sizes.churn_trees, self.sizes.churn_rounds
        models = side_by_side(
            [
                lambda: fit_churn_forest(inner, self.features, trees=trees),
                lambda: fit_churn_boosting(inner, self.features, rounds=rounds),
            ]
        )
        trial = [(n, held_out_auc(m, fold)) for n, m in zip(self.churn_models, models, strict=True)]
        return choose_model(self.train.sparkSession.createDataFrame(trial, "model string, test_auc double"))

    @cached_property
    def spend(self) -> SpendModel:
        return fit_spend(self.prepared, trees=self.sizes.spend_trees, depth=self.sizes.spend_depth)


#: Everything that is fitted by itself.
FITS = ("segmentation", "forest", "boosting", "champion", "spend")


def train_all(prepared: Prepared, sizes: TrainingSizes = TrainingSizes(), select_on: str = "validation") -> Training:
    """Every model from one prepared data set, independent ones side by side."""
    training = Training(prepared, sizes, select_on)
    training.ready(*FITS)
    training.comparison  # noqa: B018
    return training
