"""Saved models and preparation, loaded by name; absent ones are reported, not fatal."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession

from basketlens.plans.prepare import Preparation
from basketlens.plans.train import FITS, Training, WhenAsked

# Names of the artefacts a scoring job looks for.
MODEL_NAMES = ("classifier_churn", "pca", "kmeans", "regressor_monetary")
PREPARATION_NAMES = ("preparation", "preparation_monetary")


@dataclass(frozen=True)
class Bundle:
    models: Mapping = field(default_factory=dict)
    preparations: Mapping[str, Preparation] = field(default_factory=dict)
    fit: Callable[[], None] | None = None  # makes every artefact that does not exist yet

    def ready(self) -> Bundle:
        """The bundle with every artefact made."""
        if self.fit is not None:
            self.fit()
        return self

    def inventory(self, spark: SparkSession) -> DataFrame:
        """(name, loaded) for every expected artefact."""
        found = {*self.models, *self.preparations}
        return spark.createDataFrame(
            [(n, n in found) for n in (*MODEL_NAMES, *PREPARATION_NAMES)], "name string, loaded boolean"
        )


def save_model(model, path: str, name: str) -> str:
    model.write().overwrite().save(f"{path}/{name}")
    return f"{path}/{name}"


def load_model(path: str, name: str):
    reader = KMeansModel if name == "kmeans" else PipelineModel
    return reader.load(f"{path}/{name}")


def bundle_of(trained: Training) -> Bundle:
    """The artefacts of a training, each fitted when a job first asks for it."""
    return Bundle(
        WhenAsked(
            {
                "classifier_churn": lambda: trained.classifier,
                "pca": lambda: trained.components,
                "kmeans": lambda: trained.segmentation.model,
                "regressor_monetary": lambda: trained.spend.model,
            }
        ),
        WhenAsked({"preparation": lambda: trained.prepared.preparation, "preparation_monetary": lambda: trained.spend.preparation}),
        lambda: trained.ready(*FITS),
    )


def save_bundle(bundle: Bundle, spark: SparkSession, path: str) -> str:
    bundle.ready()
    for name, model in bundle.models.items():
        save_model(model, path, name)
    for name, preparation in bundle.preparations.items():
        preparation.save(spark, f"{path}/{name}")
    return path


def _absent(error: Exception) -> bool:
    text = str(error)
    return any(m in text for m in ("PATH_NOT_FOUND", "does not exist", "InvalidInputException", "FileNotFound"))


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """Whatever exists under ``path``; a damaged artefact still raises."""
    models, preparations = {}, {}
    for names, target, load in (
        (MODEL_NAMES, models, lambda n: load_model(path, n)),
        (PREPARATION_NAMES, preparations, lambda n: Preparation.load(spark, f"{path}/{n}")),
    ):
        for name in names:
            try:
                target[name] = load(name)
            except (AnalysisException, PySparkException, Py4JJavaError) as error:
                if not _absent(error):
                    raise
    return Bundle(models, preparations)
