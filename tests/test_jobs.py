"""Invariants of the fitted jobs on the smallest tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators.select import text_columns
from basketlens.plans import report, score, train
from basketlens.plans.prepare import Preparation, feature_importance, prepare, select_by_importance
from basketlens.plans.train import TrainingSizes
from basketlens.registry.workbench import Workbench
from basketlens.sources.artefacts import bundle_of, load_bundle, save_bundle, save_model
from basketlens.sources.customers import KEY, LEAKAGE_COLUMNS, TARGET
from basketlens.streaming import score_stream

SMALL = TrainingSizes(
    importance_trees=20, churn_trees=20, churn_rounds=10, spend_trees=10, spend_depth=8, segments=range(2, 5), restarts=1
)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wb(spark):
    return Workbench(spark, SF, SMALL)


@pytest.fixture(scope="module")
def bundle(wb):
    return bundle_of(wb.trained)


def test_preparation_is_balanced_scaled_and_free_of_leakage(wb):
    prepared = wb.prepared
    features = list(prepared.preparation.features)
    assert not {KEY, TARGET, *LEAKAGE_COLUMNS, "NewsletterSubscribed", "ZeroPriceCount", "PreferredHour"} & set(features)
    assert "UniqueInvoices" not in features  # r = 1 with Frequency
    counts = {r[TARGET]: r["count"] for r in prepared.train.groupBy(TARGET).count().collect()}
    assert counts[0] == counts[1]
    stats = prepared.train.agg(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).first()
    for c in features:
        assert stats[f"m_{c}"] == pytest.approx(0.0, abs=1e-9)
        assert stats[f"s_{c}"] == pytest.approx(1.0, abs=1e-9)
    train_keys = {r[KEY] for r in prepared.train.select(KEY).distinct().collect()}
    test_keys = {r[KEY] for r in prepared.test.select(KEY).collect()}
    assert not train_keys & test_keys
    assert len(train_keys | test_keys) == wb.customers.count()
    assert prepared.test.where(sum(F.col(c).isNull().cast("int") for c in features) > 0).count() == 0


def test_new_rows_are_prepared_like_the_test_side(wb):
    preparation = wb.prepared.preparation
    direct = wb.prepared.test.orderBy(KEY).toPandas()
    again = preparation.transform(wb.test_customers).orderBy(KEY).toPandas()
    features = list(preparation.features)
    np.testing.assert_allclose(again[features].to_numpy(float), direct[features].to_numpy(float), atol=1e-9)


def test_fit_scope_all_learns_from_every_row(wb):
    small = prepare(wb.customers, fit_scope="all", importance_trees=3, oversample=False)
    assert small.train.count() + small.test.count() == wb.customers.count()
    with pytest.raises(ValueError):
        prepare(wb.customers, fit_scope="some")


def test_tolerates_absent_columns(wb):
    few = wb.customers.select(KEY, TARGET, "Frequency", "AccountBalance", "TotalQuantity", "Gender")
    prepared = prepare(few, importance_trees=3, oversample=False)
    assert set(prepared.preparation.features) <= {"Frequency", "AccountBalance", "TotalQuantity", "Gender"}
    assert text_columns(prepared.test) == []


def test_importances_sum_to_one(wb):
    table = wb.prepared.unscaled_train
    found = feature_importance(table, list(wb.prepared.preparation.features), TARGET, trees=5)
    assert sum(found.values()) == pytest.approx(1.0)
    assert select_by_importance({"a": 0.005, "b": 0.0049}) == ["a"]


def test_components_cross_the_share(wb):
    curve = train.variance_curve(wb.spark, wb.trained.components).orderBy("component").collect()
    shares = [r["share"] for r in curve]
    assert shares == sorted(shares, reverse=True) and curve[-1]["cumulative"] == pytest.approx(1.0)
    kept = [r for r in curve if r["kept"]]
    assert kept[-1]["cumulative"] > 0.95
    assert len(kept) == 1 or kept[-2]["cumulative"] <= 0.95
    plane = train.projection(wb.prepared.test, wb.trained.components, (KEY,))
    assert plane.columns == [KEY, "pc1", "pc2"]


def test_sweep_and_assignment(wb, bundle):
    segmentation = wb.trained.segmentation
    rows = segmentation.scores.orderBy("k").collect()
    inertia = [r["inertia"] for r in rows]
    assert inertia == sorted(inertia, reverse=True)
    assert segmentation.best_k == max(rows, key=lambda r: (r["silhouette"], -r["k"]))["k"]
    out = score.score_segments(wb.test_customers, bundle).collect()
    assert all(r["segment"] == int(np.argmin(r["distances"])) for r in out)
    scaled = wb.prepared.preparation.transform(wb.test_customers)
    by_model = bundle.models["kmeans"].transform(bundle.models["pca"].transform(scaled)).select(KEY, "cluster").collect()
    assert {r[KEY]: r["cluster"] for r in by_model} == {r[KEY]: r["segment"] for r in out}


def test_models_beat_a_constant(wb):
    rows = {r["model"]: r for r in wb.trained.comparison.collect()}
    assert set(rows) == {"random_forest", "gradient_boosting"}
    assert all(r["train_auc"] > 0.7 and r["gap"] == pytest.approx(r["train_auc"] - r["test_auc"]) for r in rows.values())
    assert wb.trained.champion in rows
    spend = wb.trained.spend
    assert not {"MonetaryTotal", TARGET, "AvgBasket", "ValuePerProduct"} & set(spend.preparation.features)
    scored = spend.model.transform(spend.test).select("MonetaryTotal", "monetary_predicted").toPandas()
    error = ((scored["MonetaryTotal"] - scored["monetary_predicted"]) ** 2).mean()
    assert error < scored["MonetaryTotal"].var(ddof=0)


def test_champion_prefers_the_forest_on_ties(spark):
    schema = "model string, test_auc double"
    tie = spark.createDataFrame([("gradient_boosting", 0.9), ("random_forest", 0.9)], schema)
    assert train.choose_model(tie) == "random_forest"
    better = spark.createDataFrame([("gradient_boosting", 0.91), ("random_forest", 0.9)], schema)
    assert train.choose_model(better) == "gradient_boosting"


def test_top_features(wb):
    features = list(wb.prepared.preparation.features)
    top = train.top_features(wb.spark, wb.trained.churn_models["random_forest"], features, 5).collect()
    assert len(top) == 5
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)


def test_saved_models_score_the_same(wb, bundle, tmp_path):
    path = save_bundle(bundle, wb.spark, str(tmp_path / "models"))
    loaded = load_bundle(wb.spark, path)
    assert all(r["loaded"] for r in loaded.inventory(wb.spark).collect())
    a = score.run_scoring(wb.test_customers, bundle, ("all",), wb.test_customers)
    b = score.run_scoring(wb.test_customers, loaded, ("all",), wb.test_customers)
    for mode in score.MODES:
        assert a[mode].orderBy(KEY).collect() == b[mode].orderBy(KEY).collect()
    assert set(score.run_scoring(wb.test_customers, bundle, ("churn",))) == {"churn"}
    with pytest.raises(ValueError):
        score.run_scoring(wb.test_customers, bundle, ("other",))


def test_partial_bundle_is_reported(wb, bundle, tmp_path):
    save_model(bundle.models["kmeans"], str(tmp_path), "kmeans")
    found = {r["name"]: r["loaded"] for r in load_bundle(wb.spark, str(tmp_path)).inventory(wb.spark).collect()}
    assert found == {"classifier_churn": False, "pca": False, "kmeans": True, "regressor_monetary": False,
                     "preparation": False, "preparation_monetary": False}


def test_preparation_round_trip(wb, tmp_path):
    preparation = wb.prepared.preparation
    preparation.save(wb.spark, str(tmp_path / "p"))
    again = Preparation.load(wb.spark, str(tmp_path / "p"))
    for name in ("dropped", "clip", "text", "medians", "features", "scaler"):
        assert getattr(again, name) == getattr(preparation, name)


def test_churn_report(wb, bundle):
    scored = score.score_churn(wb.test_customers, bundle, wb.test_customers).collect()
    assert len(scored) == wb.test_customers.count()
    for r in scored:
        assert 0 <= r["churn_probability"] <= 1
        assert r["correct"] == (r["churn_predicted"] == r["churn_actual"])


def test_streamed_scores_equal_batch_scores(wb, bundle, tmp_path):
    batch = {tuple(r) for r in score.score_churn(wb.test_customers, bundle).collect()}
    arrived = str(tmp_path / "in")
    wb.test_customers.repartition(3).write.parquet(arrived)
    stream = score_stream.read_customers(wb.spark, arrived, wb.test_customers.schema, files_per_trigger=1)
    scored = score_stream.score_customers(stream, bundle)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    score_stream.write_available(scored, out, checkpoint).awaitTermination(120)
    written = wb.spark.read.parquet(out)
    assert {tuple(r) for r in written.select(*scored.columns).collect()} == batch
    # A restart with one more file scores only that file.
    wb.test_customers.limit(2).coalesce(1).write.mode("append").parquet(arrived)
    score_stream.write_available(scored, out, checkpoint).awaitTermination(120)
    assert wb.spark.read.parquet(out).count() == len(batch) + 2


def test_scenarios(wb, bundle):
    out = score.score_scenarios(wb.scenarios, bundle, KEY).collect()
    assert len(out) == wb.customers.count()
    for r in out:
        assert r["churn_predicted"] == int(r["churn_percent"] >= 50) or r["churn_percent"] == pytest.approx(50, abs=0.1)
        assert len(r["distances"]) == len(r["closeness"]) == wb.trained.segmentation.best_k
        assert r["closeness"][r["segment"]] == 100.0
        assert r["actions"][-1] == f"adapt_to_segment_{r['segment']}"
    diagnosed = score.diagnose(wb.scenarios, bundle, KEY).first()
    assert diagnosed["features_used"] == len(wb.prepared.preparation.features)
    assert len(diagnosed["first_scaled"]) == min(8, diagnosed["features_used"])
    assert diagnosed["monetary_predicted"] == {r[KEY]: r["monetary_predicted"] for r in out}[diagnosed[KEY]]


def test_report_tables(wb):
    risk = report.risk_distribution(wb.report).collect()
    assert [r["name"] for r in risk] == [n for n in ("Faible", "Moyen", "Élevé", "Critique") if n in {r["name"] for r in risk}]
    summary = report.prediction_summary(wb.spend, "yhat").first()
    pdf = wb.spend.toPandas()["yhat"]
    assert summary["median"] == pytest.approx(pdf.median())


def test_sizes_default_to_the_full_ones():
    full = train.TrainingSizes()
    assert (full.importance_trees, full.churn_trees, full.churn_rounds, full.spend_trees, full.restarts) == (100, 200, 200, 200, 10)
    assert list(full.segments) == [2, 3, 4, 5, 6, 7, 8]
    assert SMALL.churn_trees < full.churn_trees
