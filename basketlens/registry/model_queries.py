"""Components, segments, learners and scoring jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions import whatif
from basketlens.operators import clustering
from basketlens.operators.kmeans import kmeans_sweep
from basketlens.plans import report, score, train
from basketlens.registry.base_sql import C360, CLUSTERED, SCORED, SPEND
from basketlens.registry import feature_queries  # noqa: F401  registers the what-if SQL used below
from basketlens.registry.workbench import EXPECTED_SQL, NUMERIC, query
from basketlens.sources.artefacts import load_bundle, save_bundle
from basketlens.sources.customers import KEY, TARGET
from basketlens.streaming import score_stream


def _features(wb) -> list[str]:
    return list(wb.prepared.preparation.features)


@query("ml_pca_curve")
def variance(wb):
    return train.variance_curve(wb.spark, wb.trained.components)


@query("ev_variance_kept")
def variance_kept(wb):
    return train.variance_kept(train.variance_curve(wb.spark, wb.trained.components))


@query("ml_pca_projection")
def projected(wb):
    return train.projection(wb.prepared.test, wb.trained.components, (KEY, TARGET))


@query("ml_kmeans_sweep")
def sweep(wb):
    return wb.trained.segmentation.scores


#: Sizes and seeds of the fits that SQL repeats.
_KS, _SEEDS = (2, 3, 4), (42, 43)


def _lloyd_sql(rounds: int) -> str:
    """Lloyd's rounds of all runs at once: rows to their nearest centre, centres to the mean of their rows."""
    runs = ", ".join(f"({k}, {s})" for k in _KS for s in _SEEDS)
    return f"""e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
    runs(k, seed) AS (VALUES {runs}),
    lloyd AS (
        SELECT 0 AS round, k, seed, place AS c, x AS centre
        FROM runs JOIN (SELECT s.seed, x, row_number() OVER (PARTITION BY s.seed ORDER BY md5('kmeans' || s.seed || '|' || vec_id), vec_id) AS place
                        FROM e, (SELECT DISTINCT seed FROM runs) s) USING (seed) WHERE place <= k
        UNION ALL
        SELECT round + 1, k, seed, c, list(v ORDER BY i) FROM (
            SELECT round, k, seed, c, i, avg(x[i]) AS v FROM (
                SELECT *, unnest(range(1, 65)) AS i FROM (
                    SELECT round, k, seed, vec_id, any_value(x) AS x, arg_min(c, struct_pack(d := list_distance(x, centre), c := c)) AS c
                    FROM lloyd, e WHERE round < {rounds} GROUP BY round, k, seed, vec_id))
            GROUP BY round, k, seed, c, i)
        GROUP BY round, k, seed, c),
    placed AS (SELECT k, seed, vec_id, arg_min(c, struct_pack(d := list_distance(x, centre), c := c)) AS c, min(list_distance(x, centre)) AS d
               FROM lloyd, e WHERE round = {rounds} GROUP BY k, seed, vec_id)"""


def _runs(wb):
    table = wb.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return kmeans_sweep(table, "vec_id", F.col("x"), _KS, len(_SEEDS), _SEEDS[0], tolerance=0.0, start="draws")


@query(
    "ml_kmeans_runs",
    f"WITH RECURSIVE {_lloyd_sql(60)} SELECT k, seed, round(sum(d * d), 4) AS inertia FROM placed GROUP BY k, seed",
)
def kmeans_runs(wb):
    """Inertia of every run of a sweep, from the same first centres."""
    rows = [(r.k, r.seed, round(float(r.inertia), 4)) for r in _runs(wb).runs]
    return wb.spark.createDataFrame(rows, "k int, seed int, inertia double")


@query(
    "ml_kmeans_centres",
    f"""WITH RECURSIVE {_lloyd_sql(60)}, sums AS (SELECT k, seed, sum(d * d) AS inertia FROM placed GROUP BY k, seed),
    best AS (SELECT k, arg_min(seed, struct_pack(i := inertia, s := seed)) AS seed FROM sums GROUP BY k),
    own AS (SELECT k, list_transform(centre, lambda v: round(v, 5)) AS centre FROM lloyd JOIN best USING (k, seed) WHERE round = 60)
    SELECT k, (dense_rank() OVER (PARTITION BY k ORDER BY centre) - 1)::INTEGER AS centre, i::INTEGER AS dimension, v + 0.0 AS value
    FROM (SELECT k, centre, unnest(range(64)) AS i, unnest(centre) AS v FROM own)""",
)
def kmeans_centres(wb):
    """Centres of the best start of every k, in the order of their values."""
    sweep, rows = _runs(wb), []
    for k in _KS:
        centres = sorted([round(float(v), 5) + 0.0 for v in c] for c in sweep.best(k).centres)
        rows += [(k, c, i, v) for c, own in enumerate(centres) for i, v in enumerate(own)]
    return wb.spark.createDataFrame(rows, "k int, centre int, dimension int, value double")


@query("ml_segments")
def segment_labels(wb):
    rotated = train.rotated(wb.prepared.test, wb.trained.components)
    centres = [[float(v) for v in c] for c in wb.trained.segmentation.model.clusterCenters()]
    values = [F.col("pca")[i] for i in range(len(centres[0]))]
    distances = clustering.centre_distances(values, centres)
    return rotated.select(KEY, clustering.nearest_centre(distances).alias("cluster"))


@query(
    "ml_silhouette",
    """WITH s AS (SELECT vec_id, embedding::DOUBLE[] AS x, label AS c FROM embeddings),
    d AS (SELECT a.vec_id, a.c, b.c AS oc, sum(list_distance(a.x, b.x) ** 2) AS total, count(*) AS n FROM s a, s b GROUP BY ALL),
    w AS (SELECT vec_id, max(CASE WHEN c = oc THEN total / greatest(n - 1, 1) END) AS inner_d, min(CASE WHEN c <> oc THEN total / n END) AS outer_d,
          max(CASE WHEN c = oc THEN n END) AS own FROM d GROUP BY 1)
    SELECT (SELECT count(DISTINCT c) FROM s)::INTEGER AS clusters, count(*) AS n,
    round(avg(CASE WHEN own > 1 THEN (outer_d - inner_d) / greatest(inner_d, outer_d) ELSE 0 END), 6) AS silhouette FROM w""",
)
def silhouette(wb):
    points = wb.table("embeddings").withColumn("x", F.col("embedding").cast("array<double>"))
    return clustering.silhouette(points, "x", "label").withColumn("silhouette", F.round("silhouette", 6))


@query(
    "ml_best_k",
    f"""WITH RECURSIVE {_lloyd_sql(60)}, sums AS (SELECT k, seed, sum(d * d) AS inertia FROM placed GROUP BY k, seed),
    best AS (SELECT k, arg_min(seed, struct_pack(i := inertia, s := seed)) AS seed, min(inertia) AS inertia FROM sums GROUP BY k),
    own AS (SELECT p.k, p.vec_id, p.c, e.x FROM placed p JOIN best USING (k, seed) JOIN e USING (vec_id)),
    pairs AS (SELECT a.k, a.vec_id, a.c, b.c AS oc, sum(list_distance(a.x, b.x) ** 2) AS total, count(*) AS n FROM own a JOIN own b USING (k) GROUP BY ALL),
    widths AS (SELECT k, vec_id, max(CASE WHEN c = oc THEN total / greatest(n - 1, 1) END) AS inner_d, min(CASE WHEN c <> oc THEN total / n END) AS outer_d,
                      max(CASE WHEN c = oc THEN n END) AS size FROM pairs GROUP BY k, vec_id),
    scores AS (SELECT k, avg(CASE WHEN size > 1 THEN (outer_d - inner_d) / greatest(inner_d, outer_d) ELSE 0 END) AS silhouette FROM widths GROUP BY k)
    SELECT k, round(inertia, 4) AS inertia, round(silhouette, 6) AS silhouette,
           row_number() OVER (ORDER BY silhouette DESC, k) = 1 AS best FROM scores JOIN best USING (k)""",
)
def best_k(wb):
    """Inertia and silhouette of every k's best start, and the k that the sweep takes."""
    scores = wb.spark.createDataFrame(_runs(wb).scores, "k int, inertia double, silhouette double")
    chosen = clustering.best_k(scores).select(F.col("k").alias("chosen"))
    shown = scores.join(chosen, F.col("k") == F.col("chosen"), "left")
    return shown.select("k", F.round("inertia", 4).alias("inertia"), F.round("silhouette", 6).alias("silhouette"), F.col("chosen").isNotNull().alias("best"))


@query("ml_cluster_sizes", f"WITH {C360}, {CLUSTERED} SELECT cluster, count(*) AS n FROM clustered GROUP BY 1")
def sizes(wb):
    return clustering.cluster_sizes(wb.clustered)


_PROFILED = NUMERIC


@query(
    "ml_cluster_profiles",
    f"WITH {C360}, {CLUSTERED} SELECT cluster, {', '.join(f'round(avg({c}), 3) AS {c}' for c in _PROFILED)} FROM clustered GROUP BY 1",
)
def profiles(wb):
    return clustering.cluster_profiles(wb.clustered, list(_PROFILED))


@query(
    "ml_assign_distances",
    f"""WITH {C360}, {CLUSTERED} SELECT CustomerID, cluster, round(distances[1], 6) AS d0, round(distances[2], 6) AS d1,
    round(distances[3], 6) AS d2 FROM clustered""",
)
def distances(wb):
    return wb.clustered.select(KEY, "cluster", *[F.round(F.col("distances")[i], 6).alias(f"d{i}") for i in range(3)])


@query("ml_churn_rf")
def churn_forest(wb):
    return train.churn_probability(wb.prepared.test, wb.trained.churn_models["random_forest"], (KEY, TARGET))


@query("ml_churn_gbt")
def churn_boosting(wb):
    return train.churn_probability(wb.prepared.test, wb.trained.churn_models["gradient_boosting"], (KEY, TARGET))


@query("ml_champion")
def champion(wb):
    wb.trained.ready("forest", "boosting", "champion")
    return wb.trained.comparison.withColumn("chosen", F.col("model") == wb.trained.champion)


@query("ml_spend_rf")
def spend_forest(wb):
    spend = wb.trained.spend
    return spend.model.transform(spend.test).select(KEY, "MonetaryTotal", "monetary_predicted")


@query("ml_importance_top20")
def importance(wb):
    return train.top_features(wb.spark, wb.trained.churn_models["random_forest"], _features(wb))


@query(
    "snk_model_bundle",
    """SELECT name, true AS loaded FROM (VALUES ('classifier_churn'), ('pca'), ('kmeans'), ('regressor_monetary'), ('preparation'),
    ('preparation_monetary')) v(name)""",
)
def model_bundle(wb):
    path = save_bundle(wb.bundle, wb.spark, wb.path("models"))
    return load_bundle(wb.spark, path).inventory(wb.spark)


@query("job_churn_scores")
def churn_scores(wb):
    return score.score_churn(wb.customers, wb.bundle, wb.customers.select(KEY, TARGET))


@query("job_segments")
def segments(wb):
    return score.score_segments(wb.customers, wb.bundle)


@query("job_monetary")
def monetary(wb):
    return score.score_spend(wb.customers, wb.bundle)


@query(
    "job_modes",
    f"""WITH {C360} SELECT mode, count(*) AS rows FROM c360, (VALUES ('churn'), ('segment'), ('monetary')) v(mode) GROUP BY 1""",
)
def modes(wb):
    reports = score.run_scoring(wb.customers, wb.bundle, ("all",))
    counts = [df.agg(F.lit(mode).alias("mode"), F.count("*").alias("rows")) for mode, df in reports.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("job_whatif")
def what_if(wb):
    return score.score_scenarios(wb.scenarios, wb.bundle, KEY)


@query("job_diagnostics")
def diagnostics(wb):
    return score.diagnose(wb.scenarios, wb.bundle, KEY)


@query("job_stream_scores")
def stream_scores(wb):
    """The customer table arrives as a file stream and every row is scored once."""
    arrived = wb.path("arrived")
    wb.customers.write.parquet(arrived)
    stream = score_stream.read_customers(wb.spark, arrived, wb.customers.schema)
    out = wb.path("stream_scores")
    scored = score_stream.score_customers(stream, wb.bundle, "churn")
    score_stream.write_available(scored, out, wb.path("stream_checkpoint")).awaitTermination()
    return wb.spark.read.schema(scored.schema).parquet(out)


@query("job_stream_scenarios", EXPECTED_SQL["fn_whatif_vector"])
def stream_scenarios(wb):
    """What-if inputs arrive as a file stream; defaults and derived features are added record by record."""
    arrived = wb.path("arrived_scenarios")
    wb.scenarios.write.parquet(arrived)
    stream = whatif.with_defaults(score_stream.read_customers(wb.spark, arrived, wb.scenarios.schema))
    shown = stream.select(KEY, *[F.round(e.cast("double"), 6).alias(n) for n, e in whatif.derived_features().items()])
    out = wb.path("stream_scenarios")
    score_stream.write_available(shown, out, wb.path("stream_checkpoint")).awaitTermination()
    return wb.spark.read.schema(shown.schema).parquet(out)


@query(
    "job_prediction_summary",
    f"""WITH {C360}, {SPEND} SELECT round(avg(yhat), 4) AS mean, round(quantile_cont(yhat, 0.5), 4) AS median, round(min(yhat), 4) AS min,
    round(max(yhat), 4) AS max FROM spend""",
)
def prediction_summary(wb):
    out = report.prediction_summary(wb.spend, "yhat")
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


@query(
    "job_distributions",
    f"""WITH {C360}, {SCORED}, {CLUSTERED}
    SELECT 'risk' AS kind, risk_level AS name, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM report), 1) AS percent
    FROM report WHERE risk_level IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'segment', 'Cluster ' || cluster, count(*), round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM clustered), 1) FROM clustered GROUP BY 2""",
)
def distributions(wb):
    return report.risk_distribution(wb.report).unionByName(report.segment_distribution(wb.clustered, "cluster"))


@query(
    "job_dashboard_kpis",
    f"""WITH {C360}, {SCORED} SELECT count(*) AS clients, sum(churn_predicted)::BIGINT AS churned, round(avg(churn_predicted) * 100, 1) AS churn_rate
    FROM report""",
)
def kpis(wb):
    return report.dashboard_kpis(wb.report)


@query(
    "job_kpi_by_risk",
    f"""WITH {C360}, {SCORED} SELECT coalesce(risk_level, 'none') AS risk_level, count(*) AS clients, sum(label)::BIGINT AS churned,
    round(sum(MonetaryTotal), 2) AS spend, round(avg(Frequency), 6) AS avg_orders
    FROM report JOIN c360 USING (CustomerID) GROUP BY 1""",
)
def kpi_by_risk(wb):
    """Clients, churned clients and spend per risk level, straight from the customer table."""
    joined = wb.report.join(wb.customers.select(KEY, "MonetaryTotal", "Frequency"), KEY)
    return joined.groupBy(F.coalesce("risk_level", F.lit("none")).alias("risk_level")).agg(
        F.count("*").alias("clients"),
        F.sum(F.col("label").cast("long")).alias("churned"),
        F.round(F.sum("MonetaryTotal"), 2).alias("spend"),
        F.round(F.avg("Frequency"), 6).alias("avg_orders"),
    )
