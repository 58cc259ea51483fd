"""Fitted models and jobs, stated as rules per customer that SQL over the tables can expect.

Each row says whether a rule holds for that customer (or k); the customers, their classes and
their sides come from SQL, so a lost, doubled or foreign row shows as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from basketlens.functions.risk import decide, risk_level
from basketlens.operators import clustering, evaluate
from basketlens.plans import score, train
from basketlens.registry.base_sql import C360, SCENARIOS, SPLIT
from basketlens.registry.feature_queries import _ENTERED
from basketlens.registry.workbench import query
from basketlens.sources.artefacts import Bundle, load_bundle, save_bundle
from basketlens.sources.customers import KEY, TARGET, write_table
from basketlens.sources.shelf import Shelf
from basketlens.streaming import score_stream

MODELS = ("random_forest", "gradient_boosting")


def _every(*rules: str) -> str:
    return ", ".join(f"true AS {r}" for r in rules)


def _centres(wb) -> list[list[float]]:
    return [[float(v) for v in c] for c in wb.trained.segmentation.model.clusterCenters()]


def _least(distances: str):
    return F.col(distances)[F.col("segment")] == F.array_min(distances)


@query(
    "job_churn_rules",
    f"WITH {C360} SELECT CustomerID, Churn AS churn_actual, {_every('probable', 'decided', 'levelled', 'compared')} FROM c360",
)
def churn_rules(wb):
    p = F.col("churn_probability")
    found = score.score_churn(wb.customers, wb.bundle, wb.customers.select(KEY, TARGET))
    # Decision and level come from the unrounded probability; at a bound the rounded one may differ.
    at_bound = reduce(lambda a, b: a | b, [F.abs(p - x) < 1e-4 for x in (0.0, 0.25, 0.5, 0.75)])
    return found.select(
        KEY,
        "churn_actual",
        p.between(0, 1).alias("probable"),
        ((F.col("churn_predicted") == decide(p)) | at_bound).alias("decided"),
        (F.col("risk_level").eqNullSafe(risk_level(p)) | at_bound).alias("levelled"),
        (F.col("correct") == (F.col("churn_predicted") == F.col("churn_actual"))).alias("compared"),
    )


@query(
    "job_gaps_rules",
    f"""WITH {C360} SELECT CustomerID, CASE WHEN CustomerID % 7 <> 0 THEN Churn END AS churn_actual,
    CustomerID % 7 <> 0 AS compared, {_every('churn', 'segment', 'spend')} FROM c360""",
)
def gaps_rules(wb):
    """A batch with missing numbers, unseen categories and customers without a known class loses nobody."""
    key = F.col(KEY)
    batch = wb.customers.withColumns(
        {
            "Frequency": F.when(key % 3 != 0, F.col("Frequency")),
            "TotalQuantity": F.when(key % 4 != 0, F.col("TotalQuantity")),
            "AccountBalance": F.when(key % 5 != 0, F.col("AccountBalance")),
            "Country": F.when(key % 2 == 0, F.lit("nowhere")).otherwise(F.col("Country")),
        }
    )
    actuals = wb.customers.where(key % 7 != 0).select(KEY, TARGET)
    reports = score.run_scoring(batch, wb.bundle, ("all",), actuals)
    churn = reports["churn"].select(
        KEY, "churn_actual", F.col("correct").isNotNull().alias("compared"), F.col("churn_probability").isNotNull().alias("churn")
    )
    segment = reports["segment"].select(KEY, _least("distances").alias("segment"))
    spend = reports["monetary"].select(KEY, (F.col("monetary_predicted") >= 0).alias("spend"))
    return churn.join(segment, KEY, "full").join(spend, KEY, "full")


@query("job_segment_rules", f"WITH {C360} SELECT CustomerID, {_every('nearest', 'all_centres')} FROM c360")
def segment_rules(wb):
    found = score.score_segments(wb.customers, wb.bundle)
    k = wb.trained.segmentation.best_k
    return found.select(KEY, _least("distances").alias("nearest"), (F.size("distances") == k).alias("all_centres"))


@query("job_monetary_rules", f"WITH {C360} SELECT CustomerID, {_every('within_training')} FROM c360")
def monetary_rules(wb):
    """A forest's prediction lies between the smallest and largest spend it learned from."""
    bounds = wb.customers.agg(F.min("MonetaryTotal").alias("low"), F.max("MonetaryTotal").alias("high")).first()
    found = score.score_spend(wb.customers, wb.bundle)
    return found.select(KEY, F.col("monetary_predicted").between(bounds["low"] - 0.01, bounds["high"] + 0.01).alias("within_training"))


@query("job_whatif_rules", f"WITH {C360} SELECT CustomerID, {_every('percent', 'decided', 'closest', 'advised')} FROM c360")
def whatif_rules(wb):
    found = score.score_scenarios(wb.scenarios, wb.bundle, KEY)
    percent = F.col("churn_percent")
    return found.select(
        KEY,
        percent.between(0, 100).alias("percent"),
        ((F.col("churn_predicted") == (percent >= 50).cast("int")) | (F.abs(percent - 50) <= 0.1)).alias("decided"),
        # Closeness is measured on the distances as shown: where those are all equal, none is nearer.
        (
            F.col("closeness")[F.col("segment")] == F.when(F.array_min("distances") < F.array_max("distances"), 100.0).otherwise(0.0)
        ).alias("closest"),
        (F.element_at("actions", -1) == F.concat(F.lit("adapt_to_segment_"), F.col("segment"))).alias("advised"),
    )


@query("job_diagnostics_rules", f"WITH {C360} SELECT CustomerID, {_every('same_churn', 'same_segment', 'same_spend')} FROM c360")
def diagnostics_rules(wb):
    """The diagnosis of a scenario and its score come from the same models."""
    scored = score.score_scenarios(wb.scenarios, wb.bundle, KEY).select(
        KEY, "churn_percent", F.col("segment").alias("of"), F.col("monetary_predicted").alias("spend")
    )
    both = score.diagnose(wb.scenarios, wb.bundle, KEY).join(scored, KEY, "full")
    return both.select(
        KEY,
        (F.abs(F.col("churn_probability") * 100 - F.col("churn_percent")) <= 0.06).alias("same_churn"),
        (F.col("segment") == F.col("of")).alias("same_segment"),
        (F.abs(F.col("monetary_predicted") - F.col("spend")) < 0.011).alias("same_spend"),
    )


@query("job_stream_rules", f"WITH {C360} SELECT CustomerID, {_every('same')} FROM c360")
def stream_rules(wb):
    """Every customer of a file stream gets the scores of the batch job, once."""
    arrived, out = wb.path("arrived"), wb.path("stream_scores")
    wb.customers.write.parquet(arrived)
    stream = score_stream.read_customers(wb.spark, arrived, wb.customers.schema)
    scored = score_stream.score_customers(stream, wb.bundle, "churn")
    score_stream.write_available(scored, out, wb.path("stream_checkpoint")).awaitTermination()
    streamed = wb.spark.read.schema(scored.schema).parquet(out)
    return _same(streamed, score.score_churn(wb.customers, wb.bundle))


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    values = [c for c in left.columns if c != KEY]
    a = left.select(KEY, F.struct(*values).alias("a"))
    b = right.select(KEY, F.struct(*values).alias("b"))
    return a.join(b, KEY, "full").select(KEY, F.col("a").eqNullSafe(F.col("b")).alias("same"))


@query(
    "snk_bundle_rules",
    f"WITH {C360} SELECT mode, CustomerID, {_every('same')} FROM c360, (VALUES ('churn'), ('segment'), ('monetary')) v(mode)",
)
def bundle_rules(wb):
    """A saved and reloaded bundle scores every customer as the fitted models do."""
    loaded = load_bundle(wb.spark, save_bundle(wb.bundle, wb.spark, wb.path("models")))
    fitted, again = (score.run_scoring(wb.customers, b, ("all",)) for b in (wb.bundle, loaded))
    same = [_same(fitted[m], again[m]).select(F.lit(m).alias("mode"), KEY, "same") for m in score.MODES]
    return reduce(DataFrame.unionByName, same)


@query(
    "snk_partial_bundle",
    """SELECT name, name IN ('pca', 'kmeans', 'preparation') AS loaded FROM (VALUES ('classifier_churn'), ('pca'), ('kmeans'),
    ('regressor_monetary'), ('preparation'), ('preparation_monetary')) v(name)""",
)
def partial_bundle(wb):
    """Absent artefacts are reported, what is there is loaded."""
    whole = wb.bundle
    part = Bundle({n: whole.models[n] for n in ("pca", "kmeans")}, {"preparation": whole.preparations["preparation"]})
    return load_bundle(wb.spark, save_bundle(part, wb.spark, wb.path("models"))).inventory(wb.spark)


@query("snk_segment_report", f"WITH {C360} SELECT CustomerID, {_every('same')} FROM c360")
def segment_report(wb):
    found = score.score_segments(wb.customers, wb.bundle).withColumn("distances", F.to_json("distances"))
    path = write_table(found, wb.path("segment_report"), "csv")
    return _same(found, wb.spark.read.schema(found.schema).option("header", True).csv(path))


@query("snk_spend_report", f"WITH {C360} SELECT CustomerID, {_every('same')} FROM c360")
def spend_report(wb):
    found = score.score_spend(wb.customers, wb.bundle)
    path = write_table(found, wb.path("spend_report"), "csv")
    return _same(found, wb.spark.read.schema(found.schema).option("header", True).csv(path))


@query(
    "ml_train_projection",
    f"""WITH {C360}, {SPLIT} SELECT CustomerID, Churn, {_every('projected', 'nearest')} FROM split WHERE side = 'train'""",
)
def train_projection(wb):
    """First two components and segment of the training customers."""
    rows = wb.prepared.train.where("copy = 0")
    rotated = train.rotated(rows, wb.trained.components)
    centres = _centres(wb)
    distances = clustering.centre_distances([F.col("pca")[i] for i in range(len(centres[0]))], centres)
    labelled = rotated.withColumn("distances", distances).withColumn("segment", clustering.nearest_centre(F.col("distances")))
    plane = train.projection(rows, wb.trained.components, (KEY,))
    both = labelled.join(plane, KEY, "full")
    return both.select(
        KEY, TARGET, (F.col("pc1").isNotNull() & F.col("pc2").isNotNull()).alias("projected"), _least("distances").alias("nearest")
    )


@query("ml_trained_profiles")
def trained_profiles(wb):
    """Mean of every model feature per segment of the training customers."""
    rotated = train.rotated(wb.prepared.train.where("copy = 0"), wb.trained.components)
    values = [F.col("pca")[i] for i in range(len(_centres(wb)[0]))]
    labelled = rotated.withColumn("cluster", clustering.nearest_centre(clustering.centre_distances(values, _centres(wb))))
    return clustering.cluster_profiles(labelled, list(wb.prepared.preparation.features))


@query("ml_sweep_rules", f"SELECT k::INTEGER AS k, {_every('inertia_falls', 'silhouette_in_range')} FROM generate_series(2, 8) g(k)")
def sweep_rules(wb):
    scores = wb.trained.segmentation.scores
    fewer = scores.select((F.col("k") + 1).alias("k"), F.col("inertia").alias("before"))
    return scores.join(fewer, "k", "left").select(
        "k",
        F.coalesce(F.col("inertia") <= F.col("before") * (1 + 1e-9), F.lit(True)).alias("inertia_falls"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
    )


@query(
    "ml_churn_rules",
    f"""WITH {C360}, {SPLIT} SELECT model, CustomerID, Churn, {_every('probable', 'decided')}
    FROM split, (VALUES ('random_forest'), ('gradient_boosting')) v(model) WHERE side = 'test'""",
)
def classifier_rules(wb):
    wb.trained.ready("forest", "boosting")
    found = []
    for name in MODELS:
        scored = train.churn_probability(wb.prepared.test, wb.trained.churn_models[name], (KEY, TARGET))
        p = F.col("churn_probability")
        found.append(
            scored.select(
                F.lit(name).alias("model"),
                KEY,
                TARGET,
                p.between(0, 1).alias("probable"),
                ((F.col("churn_predicted") == (p > 0.5).cast("int")) | (F.abs(p - 0.5) < 1e-9)).alias("decided"),
            )
        )
    return found[0].unionByName(found[1])


@query(
    "ev_confusion_totals",
    f"""WITH {C360}, {SPLIT} SELECT model, Churn AS actual, count(*) AS n
    FROM split, (VALUES ('random_forest'), ('gradient_boosting')) v(model) WHERE side = 'test' GROUP BY ALL""",
)
def confusion_totals(wb):
    """Rows of the trained classifiers' confusion matrices add up to the test customers of each class."""
    wb.trained.ready("forest", "boosting")
    cells = [_scored(wb, n).transform(lambda d: evaluate.confusion_matrix(d, TARGET, "churn_predicted")).withColumn("model", F.lit(n)) for n in MODELS]
    return cells[0].unionByName(cells[1]).groupBy("model", "actual").agg(F.sum("n").alias("n")).where("n > 0")


def _scored(wb, name: str) -> DataFrame:
    return train.churn_probability(wb.prepared.test, wb.trained.churn_models[name], (KEY, TARGET))


@query("ev_trained_classifiers")
def trained_classifiers(wb):
    """Class report of both trained classifiers on the test customers."""
    wb.trained.ready("forest", "boosting")
    reports = [evaluate.class_report(_scored(wb, n), TARGET, "churn_predicted").withColumn("model", F.lit(n)) for n in MODELS]
    return reports[0].unionByName(reports[1])


@query("ev_trained_roc")
def trained_roc(wb):
    """ROC points of the champion on the test customers."""
    wb.trained.ready("forest", "boosting", "champion")
    return evaluate.roc_curve(_scored(wb, wb.trained.champion), TARGET, "churn_probability")


@query("ev_trained_spend")
def trained_spend(wb):
    """Errors of the trained spend model on its test customers."""
    spend = wb.trained.spend
    return evaluate.regression_metrics(spend.model.transform(spend.test), "MonetaryTotal", "monetary_predicted")


@query(
    "job_scenario_stream",
    f"""WITH {C360}, {SCENARIOS}, {_ENTERED} SELECT CustomerID, 1::BIGINT AS times, round(MonetaryTotal, 2) AS entered,
    true AS consistent, true AS same FROM entered""",
)
def scenario_stream(wb):
    """A scenario stream through all three models that is killed within a batch, restarted and given new models meanwhile."""
    arrived, out, checkpoint = wb.path("scenario_files"), wb.path("scenario_scores"), wb.path("scenario_checkpoint")
    wb.scenarios.repartition(4).write.parquet(arrived)
    shelf = Shelf(wb.spark, wb.path("shelf"))
    shelf.publish(wb.bundle)
    stream = score_stream.read_customers(wb.spark, arrived, wb.scenarios.schema, files_per_trigger=1)
    begun = []

    def killed(rows, bundle):
        begun.append(1)
        scored = score_stream.score_scenario_stream(rows, bundle, KEY)
        # The second batch fails in one of its tasks, after others may have written.
        return scored if len(begun) < 2 else scored.where(F.when(F.col(KEY) > 0, F.raise_error(F.lit("killed"))).isNull())

    try:
        score_stream.write_batches(stream, killed, shelf, out, checkpoint).awaitTermination()
    except StreamingQueryException:
        shelf.publish(wb.bundle)
    whole = lambda rows, bundle: score_stream.score_scenario_stream(rows, bundle, KEY)
    score_stream.write_batches(stream, whole, shelf, out, checkpoint).awaitTermination()
    scored = score_stream.read_batches(wb.spark, out)
    batch = score.score_scenarios(wb.scenarios, wb.bundle, KEY).select(KEY, F.struct("churn_percent", "segment", "monetary_predicted").alias("want"))
    levels = ("Faible", "Moyen", "Élevé", "Critique")
    percent = F.col("churn_percent")
    # The level by the shown percentage; at a bound the unrounded one may differ.
    expected = F.when(percent < 25, levels[0]).when(percent < 50, levels[1]).when(percent < 75, levels[2]).otherwise(levels[3])
    at_bound = reduce(lambda a, b: a | b, [F.abs(percent - x) < 0.1 for x in (25, 50, 75)])
    found = scored.groupBy(KEY).agg(
        F.count("*").alias("times"),
        F.round(F.first(F.col("monetary_predicted") - F.col("spend_delta")), 2).alias("entered"),
        F.first((F.col("risk_level") == expected) | at_bound).alias("consistent"),
        F.first(F.struct("churn_percent", "segment", "monetary_predicted")).alias("found"),
    )
    return found.join(batch, KEY, "full").select(KEY, "times", "entered", "consistent", F.col("found").eqNullSafe(F.col("want")).alias("same"))


@query(
    "snk_published_bundle",
    """SELECT version::BIGINT AS version, name, version = 2 AS current FROM (VALUES (1, 'pca'), (1, 'kmeans'), (1, 'preparation'),
    (2, 'classifier_churn'), (2, 'pca'), (2, 'kmeans'), (2, 'regressor_monetary'), (2, 'preparation'), (2, 'preparation_monetary')) v(version, name)""",
)
def published_bundle(wb):
    """A partial and a whole version are published, a save without a manifest is not, and a third version is taken back."""
    whole = wb.bundle
    shelf = Shelf(wb.spark, wb.path("shelf"))
    shelf.publish(Bundle({n: whole.models[n] for n in ("pca", "kmeans")}, {"preparation": whole.preparations["preparation"]}))
    shelf.publish(whole)
    save_bundle(whole, wb.spark, f"{shelf.root}/bundle-interrupted")
    shelf.publish(Bundle({}, {"preparation": whole.preparations["preparation"]}))
    shelf.retract()
    return shelf.inventory()
