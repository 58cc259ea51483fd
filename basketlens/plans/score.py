"""Scoring jobs: churn, segments, spend, what-if scenarios and model diagnostics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from basketlens.functions.risk import closeness, decide, recommendations, risk_level, spend_delta
from basketlens.functions.whatif import derived_features, feature_columns, with_defaults
from basketlens.operators.clustering import centre_distances, nearest_centre
from basketlens.plans.prepare import Preparation
from basketlens.plans.train import churn_probability
from basketlens.sources.artefacts import Bundle
from basketlens.sources.customers import KEY, TARGET

MODES = ("churn", "segment", "monetary")


def _centres(bundle: Bundle) -> list[list[float]]:
    return [[float(v) for v in c] for c in bundle.models["kmeans"].clusterCenters()]


def _segments(scaled: DataFrame, bundle: Bundle) -> DataFrame:
    """Segment and distance to every centre; other columns pass through."""
    rotated = bundle.models["pca"].transform(scaled).withColumn("pca", vector_to_array("pca"))
    centres = _centres(bundle)
    values = [F.col("pca")[i] for i in range(len(centres[0]))]
    return (
        rotated.withColumn("distances", centre_distances(values, centres))
        .withColumn("segment", nearest_centre(F.col("distances")))
        .drop("features", "centred", "components")
    )


def score_churn(df: DataFrame, bundle: Bundle, actuals: DataFrame | None = None) -> DataFrame:
    """Decision, probability (4 decimals) and risk level per customer.

    ``actuals(key, label)`` adds the true class and whether the decision is right;
    rows meet by key, never by position. A customer without a known class is scored
    all the same, with both left empty.
    """
    scaled = bundle.preparations["preparation"].transform(df)
    scored = churn_probability(scaled, bundle.models["classifier_churn"], (KEY,))
    report = scored.select(
        KEY,
        "churn_predicted",
        F.bround("churn_probability", 4).alias("churn_probability"),
        risk_level(F.col("churn_probability")).alias("risk_level"),
    )
    if actuals is None:
        return report
    truth = actuals.select(F.col(KEY).alias("_key"), F.col(TARGET).cast("int").alias("churn_actual"))
    joined = report.join(truth, F.col(KEY) == F.col("_key"), "left").drop("_key")
    return joined.withColumn("correct", F.col("churn_predicted") == F.col("churn_actual"))


def score_segments(df: DataFrame, bundle: Bundle) -> DataFrame:
    scaled = bundle.preparations["preparation"].transform(df)
    return _segments(scaled, bundle).select(KEY, "segment", "distances")


def score_spend(df: DataFrame, bundle: Bundle) -> DataFrame:
    scaled = bundle.preparations["preparation_monetary"].transform(df)
    predicted = bundle.models["regressor_monetary"].transform(scaled)
    return predicted.select(KEY, F.bround("monetary_predicted", 2).alias("monetary_predicted"))


def run_scoring(
    df: DataFrame, bundle: Bundle, modes: tuple[str, ...] = MODES, actuals: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The reports of the wanted modes ("all" for every one)."""
    wanted = MODES if "all" in modes else modes
    unknown = set(wanted) - set(MODES)
    if unknown:
        raise ValueError(f"unknown scoring modes: {sorted(unknown)}")
    jobs = {
        "churn": lambda: score_churn(df, bundle, actuals),
        "segment": lambda: score_segments(df, bundle),
        "monetary": lambda: score_spend(df, bundle),
    }
    if set(wanted) == set(MODES):
        bundle.ready()
    return {mode: jobs[mode]() for mode in wanted}


def _features(preparation: Preparation, spend: str) -> list[Column]:
    """Model columns of one model as expressions over the entered fields.

    The medians only serve the churn and segment features; the spend model falls
    back to 0.
    """
    medians = preparation.medians if spend == "entered" else {}
    return feature_columns(list(preparation.features), derived_features(spend, shared_basket=True), medians)


def score_scenarios(scenarios: DataFrame, bundle: Bundle, key: str) -> DataFrame:
    """Churn, segment, spend and recommendations for a table of what-if inputs.

    All three models score the same row in one pass; nothing is shuffled.
    """
    bundle.ready()
    filled = with_defaults(scenarios).withColumn("entered_total", F.col("MonetaryTotal"))
    churn, spend = bundle.preparations["preparation"], bundle.preparations["preparation_monetary"]
    both = filled.select(
        key,
        "entered_total",
        F.struct(*_features(churn, "entered")).alias("for_churn"),
        F.struct(*_features(spend, "average")).alias("for_spend"),
    )
    first = churn.scaler.transform(both.select(key, "entered_total", "for_spend", "for_churn.*"))
    scored = _segments(first, bundle)
    scored = bundle.models["classifier_churn"].transform(scored).select(
        key, "entered_total", "for_spend", "segment", "distances", vector_to_array("probability")[1].alias("p")
    )
    second = spend.scaler.transform(
        scored.select(key, "entered_total", "segment", "distances", "p", "for_spend.*")
    )
    # Closeness is measured on the distances as shown.
    result = bundle.models["regressor_monetary"].transform(second).withColumn(
        "distances", F.transform("distances", lambda d: F.bround(d, 3))
    )
    level = risk_level(F.col("p"), closed="left")
    predicted = F.bround("monetary_predicted", 2)
    return result.select(
        key,
        F.bround(F.col("p") * 100, 1).alias("churn_percent"),
        decide(F.col("p")).alias("churn_predicted"),
        level.alias("risk_level"),
        "segment",
        "distances",
        closeness(F.col("distances")).alias("closeness"),
        predicted.alias("monetary_predicted"),
        spend_delta(predicted, F.col("entered_total")).alias("spend_delta"),
        recommendations(level, predicted, F.col("entered_total"), F.col("segment")).alias("actions"),
    )


def diagnose(scenarios: DataFrame, bundle: Bundle, key: str) -> DataFrame:
    """What each model does with a scenario: raw and scaled means, components, distances, predictions."""
    bundle.ready()
    filled = with_defaults(scenarios)
    churn, spend = bundle.preparations["preparation"], bundle.preparations["preparation_monetary"]
    features = list(churn.features)
    mean = sum((F.col(f) for f in features), F.lit(0.0)) / len(features)
    both = filled.select(
        key, F.struct(*_features(churn, "entered")).alias("for_churn"), F.struct(*_features(spend, "average")).alias("for_spend")
    )
    before = both.select(key, "for_spend", "for_churn.*").withColumn("mean_before", F.bround(mean, 4))
    scored = bundle.models["classifier_churn"].transform(_segments(churn.scaler.transform(before), bundle))
    shares = bundle.models["pca"].stages[2].explainedVariance.toArray()
    kept = bundle.models["pca"].stages[3].getIndices()
    shown = scored.select(
        key,
        F.lit(len(features)).alias("features_used"),
        "mean_before",
        F.bround(mean, 4).alias("mean_after"),
        F.array(*[F.bround(F.col(f), 4) for f in features[:8]]).alias("first_scaled"),
        F.transform("pca", lambda v: F.bround(v, 4)).alias("pca_scores"),
        F.lit(round(float(sum(shares[i] for i in kept)) * 100, 2)).alias("variance_percent"),
        "segment",
        F.transform("distances", lambda d: F.bround(d, 4)).alias("centre_distances"),
        F.bround(vector_to_array("probability")[1], 4).alias("churn_probability"),
        F.lit(len(spend.features)).alias("spend_features_used"),
        "for_spend",
    )
    names = [c for c in shown.columns if c != "for_spend"]
    predicted = bundle.models["regressor_monetary"].transform(spend.scaler.transform(shown.select(*names, "for_spend.*")))
    return predicted.select(*names, F.bround("monetary_predicted", 2).alias("monetary_predicted"))
