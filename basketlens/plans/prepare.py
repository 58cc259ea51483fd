"""The preparation job: raw customer table to balanced, scaled train and test sets.

Everything that is learned (dropped columns, clip bounds, label codes, medians,
pruned features, scaling) is learned on the training side and kept in a
``Preparation`` that is applied unchanged to test rows, new batches and streams.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.functions.cleaning import add_ratios, date_parts, flag_private, out_of_range_to_null, to_number, winsorise
from basketlens.operators.correlation import correlated_columns
from basketlens.operators.encode import apply_labels, fit_labels
from basketlens.operators.quantiles import exact_quantiles
from basketlens.operators.scaling import Scaler, fill_medians, fit_scaler, impute, train_medians
from basketlens.operators.select import (
    align,
    drop_useless,
    guard_features,
    text_columns,
    useless_columns,
)
from basketlens.operators.smote import smote
from basketlens.operators.split import stratified_split
from basketlens.sources.customers import KEY, TARGET, canonical_names, nan_to_null, write_table
from basketlens.staging import enable_checkpoints, stage

CLIPPED = "MonetaryTotal"
CLIP_QUANTILES = (0.01, 0.99)


@dataclass(frozen=True)
class Preparation:
    dropped: tuple[str, ...]
    clip: tuple[float, float] | None
    text: tuple[str, ...]
    labels: DataFrame  # (column, value, code)
    medians: dict[str, float]
    features: tuple[str, ...]
    scaler: Scaler

    def clean(self, df: DataFrame) -> DataFrame:
        """Names, dropped columns, dates, addresses, ranges, clipping and ratios; one narrow projection."""
        return clean(nan_to_null(canonical_names(df)).drop(*self.dropped), self.clip)

    def encode(self, df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        """Cleaned rows as numbers."""
        ready = [c for c in self.text if c in df.columns]
        coded = apply_labels(df, self.labels, ready)
        rest = [c for c in coded.columns if c not in keep and c not in ready]
        numbers = [to_number(F.col(c)).alias(c) if c in text_columns(coded) else F.col(c).cast("double").alias(c) for c in rest]
        return coded.select(*keep, *[F.col(c).cast("double").alias(c) for c in ready], *numbers)

    def raw_features(self, df: DataFrame, keep: tuple[str, ...] = (KEY,)) -> DataFrame:
        """Imputed, aligned features before scaling; what no median fills is 0."""
        kept = tuple(c for c in keep if c in df.columns)
        ready = align(impute(self.encode(self.clean(df), kept), self.medians), list(self.features), kept)
        return impute(ready, {c: 0.0 for c in self.features})

    def transform(self, df: DataFrame, keep: tuple[str, ...] = (KEY,)) -> DataFrame:
        return self.scaler.transform(self.raw_features(df, keep))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("dropped", c, i, None) for i, c in enumerate(self.dropped)]
        rows += [("clip", CLIPPED, i, v) for i, v in enumerate(self.clip or ())]
        rows += [("text", c, i, None) for i, c in enumerate(self.text)]
        rows += [("median", c, i, float(v)) for i, (c, v) in enumerate(self.medians.items())]
        rows += [("feature", c, i, None) for i, c in enumerate(self.features)]
        rows += [("mean", c, i, v) for i, (c, v) in enumerate(zip(self.scaler.columns, self.scaler.means))]
        rows += [("deviation", c, i, v) for i, (c, v) in enumerate(zip(self.scaler.columns, self.scaler.deviations))]
        settings = spark.createDataFrame(rows, "kind string, name string, position int, value double")
        write_table(settings.coalesce(1), f"{path}/settings")
        write_table(self.labels, f"{path}/labels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preparation:
        kinds: dict[str, list] = {}
        for r in spark.read.parquet(f"{path}/settings").orderBy("kind", "position").collect():
            kinds.setdefault(r["kind"], []).append((r["name"], r["value"]))
        names = {k: tuple(n for n, _ in v) for k, v in kinds.items()}
        values = {k: tuple(x for _, x in v) for k, v in kinds.items()}
        return Preparation(
            dropped=names.get("dropped", ()),
            clip=values["clip"] if "clip" in values else None,
            text=names.get("text", ()),
            labels=spark.read.parquet(f"{path}/labels"),
            medians=dict(kinds.get("median", [])),
            features=names["feature"],
            scaler=Scaler(names["mean"], values["mean"], values["deviation"]),
        )


@dataclass(frozen=True)
class Prepared:
    processed: DataFrame  # cleaned numbers before imputation, with key, label and split
    train: DataFrame  # key, copy, label, scaled features; balanced
    test: DataFrame  # key, label, scaled features
    unscaled_train: DataFrame
    preparation: Preparation


def clean(df: DataFrame, clip: tuple[float, float] | None) -> DataFrame:
    out = out_of_range_to_null(flag_private(date_parts(df)))
    if clip and CLIPPED in df.columns:
        out = out.withColumn(CLIPPED, winsorise(F.col(CLIPPED), *clip))
    return add_ratios(out)


def clip_bounds(df: DataFrame) -> tuple[float, float] | None:
    if CLIPPED not in df.columns:
        return None
    low, high = exact_quantiles(df, [CLIPPED], list(CLIP_QUANTILES))[CLIPPED].values()
    return None if low is None else (low, high)


def feature_importance(
    train: DataFrame, features: list[str], label: str, trees: int = 100, depth: int = 8, leaf: int = 5, seed: int = 42
) -> dict[str, float]:
    """Gini importance of each feature in a forest."""
    enable_checkpoints(train.sparkSession)
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(
        train.select(F.col(label).cast("double").alias("label"), *features)
    )
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, maxBins=64, seed=seed, cacheNodeIds=True
    )
    model = forest.fit(vectors.select("label", "features"))
    return dict(zip(features, model.featureImportances.toArray().tolist()))


def select_by_importance(importances: dict[str, float], threshold: float = 0.005) -> list[str]:
    return [f for f, v in importances.items() if v >= threshold]


def prepare(
    raw: DataFrame,
    key: str = KEY,
    target: str = TARGET,
    fit_scope: str = "train",
    test_fraction: float = 0.2,
    seed: int = 42,
    missing_threshold: float = 0.5,
    correlation_threshold: float = 0.85,
    importance_threshold: float = 0.005,
    importance_trees: int = 100,
    oversample: bool = True,
    interpolate_codes: bool = True,
    neighbour_trees: int = 0,
) -> Prepared:
    """Clean, engineer, split, impute, prune, balance and scale.

    ``fit_scope="all"`` learns the steps before the split from every row, for
    comparison with pipelines that do so; the default learns from train rows only.
    ``interpolate_codes=False`` gives synthetic rows an existing label code instead
    of a value between two codes. ``neighbour_trees`` makes the balancing's neighbour search
    approximate with bounded work per row, for long tables with many features.
    """
    if fit_scope not in ("train", "all"):
        raise ValueError("fit_scope must be 'train' or 'all'")
    table = stratified_split(nan_to_null(canonical_names(raw)), target, key, test_fraction, seed)
    seen = table.where(F.col("split") == "train") if fit_scope == "train" else table
    meta = (key, target, "split")

    constant, sparse = useless_columns(seen, missing_threshold, exempt=meta)
    useful = drop_useless(seen, constant, keep_key=True)
    dropped = tuple(c for c in table.columns if c not in useful.columns or c in sparse)
    clip = clip_bounds(seen)
    cleaned = clean(table.drop(*dropped), clip)
    text = tuple(c for c in text_columns(cleaned) if c not in meta)
    labels = fit_labels(cleaned.where(F.col("split") == "train") if fit_scope == "train" else cleaned, list(text))

    preparation = Preparation(dropped, clip, text, labels, {}, (), Scaler((), (), ()))
    processed = stage(preparation.encode(cleaned, meta), "processed", partition_by=("split",))
    candidates = guard_features([c for c in processed.columns if c not in meta], target)
    train, test = (processed.where(F.col("split") == side).drop("split") for side in ("train", "test"))

    observed = train
    medians = train_medians(observed, candidates, test)
    train, test = impute(train, medians), impute(test, medians)
    correlated = set(correlated_columns(train, candidates, correlation_threshold))
    candidates = [c for c in candidates if c not in correlated]
    importances = feature_importance(train, candidates, target, trees=importance_trees, seed=seed)
    features = select_by_importance(importances, importance_threshold)
    medians = fill_medians(observed, features, medians)

    test = test.select(key, target, *features)
    if oversample:
        codes = () if interpolate_codes else tuple(c for c in features if c in text)
        rows = train.select(key, target, *features)
        balanced = stage(smote(rows, features, target, key, seed=seed, categorical=codes, trees=neighbour_trees), "balanced")
    else:
        balanced = train.select(key, F.lit(0).alias("copy"), target, *features)
    scaler = fit_scaler(balanced, features)
    preparation = replace(preparation, medians=medians, features=tuple(features), scaler=scaler)
    return Prepared(processed, scaler.transform(balanced), scaler.transform(test), balanced, preparation)

