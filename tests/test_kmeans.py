"""The K-Means sweep against single fits, its scans, and odd tables."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from basketlens.operators.clustering import centre_distances, nearest_centre, silhouette
from basketlens.operators.kmeans import _nearest, kmeans_sweep
from basketlens.plans.train import dealt, fit_segments, segment_model, sweep_segments

POINTS = "key long, x array<double>"


def groups(seed, n=600, d=6, clusters=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, d)) * 8
    return middle[rng.integers(0, clusters, n)] + rng.normal(size=(n, d))


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], POINTS).repartition(5)


def lloyd(x, centres, rounds=300, tolerance=1e-4):
    """One run alone."""
    for _ in range(rounds):
        own = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[own == c].mean(0) if (own == c).any() else old for c, old in enumerate(centres)])
        moved = ((new - centres) ** 2).sum(1).max()
        centres = new
        if moved <= tolerance**2:
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_runs_equal_single_fits_from_the_same_start(spark):
    x = groups(1)
    first = kmeans_sweep(table(spark, x), "key", F.col("x"), range(2, 6), 3, max_rounds=1, start="draws", score=False)
    whole = kmeans_sweep(table(spark, x), "key", F.col("x"), range(2, 6), 3, start="draws", score=False)
    draws = {
        s: [r["x"] for r in table(spark, x).orderBy(F.md5(F.concat(F.lit(f"kmeans{s}|"), F.col("key").cast("string")))).limit(5).collect()]
        for s in (42, 43, 44)
    }
    assert len(whole.runs) == 12 and all(r.rounds == 1 for r in first.runs)
    for run in whole.runs:
        centres, inertia = lloyd(x, np.array(draws[run.seed][: run.k]))
        assert np.allclose(run.centres, centres) and np.isclose(run.inertia, inertia)


def test_scans_do_not_grow_with_the_runs(spark):
    x = groups(2)
    few = kmeans_sweep(table(spark, x), "key", F.col("x"), range(4, 5), 1, start="spread")
    many = kmeans_sweep(table(spark, x), "key", F.col("x"), range(2, 9), 10, start="spread")
    assert len(many.runs) == 70
    assert few.scans == 4 + few.runs[0].rounds + 3
    assert many.scans == 8 + max(r.rounds for r in many.runs) + 3


def test_inertia_is_that_of_the_library_or_less(spark):
    x = groups(3, n=900, d=8, clusters=6)
    df = table(spark, x)
    sweep = kmeans_sweep(df, "key", F.col("x"), range(2, 9), 10)
    vectors = df.select(array_to_vector("x").alias("features"))
    for k in (2, 4, 6, 8):
        best = min(KMeans(k=k, seed=s, maxIter=300).fit(vectors).summary.trainingCost for s in range(4))
        assert sweep.best(k).inertia <= best * 1.01
    assert [s[0] for s in sweep.scores] == list(range(2, 9)) and max(sweep.scores, key=lambda s: s[2])[0] == 6


def test_scores_equal_the_silhouette_of_the_labels(spark):
    x = groups(4, n=300)
    df = table(spark, x)
    sweep = kmeans_sweep(df, "key", F.col("x"), range(2, 5), 2)
    for k, inertia, width in sweep.scores:
        centres = sweep.best(k).centres.tolist()
        distances = centre_distances([F.col("x")[i] for i in range(6)], centres)
        labelled = df.withColumn("c", nearest_centre(distances))
        assert np.isclose(silhouette(labelled, "x", "c").first()["silhouette"], width)
        assert np.isclose(labelled.select(F.sum(F.pow(F.array_min(distances), 2))).first()[0], inertia)


def test_partitions_play_no_part(spark):
    x = groups(5, n=200)
    found = []
    for parts in (1, 7):
        df = table(spark, x).repartition(parts)
        found.append([(r.k, r.seed, r.rounds, r.centres) for r in kmeans_sweep(df, "key", F.col("x"), (3, 4), 2, score=False).runs])
    assert all(a[:3] == b[:3] and np.allclose(a[3], b[3]) for a, b in zip(*found, strict=True))


def test_few_distinct_rows_missing_rows_and_none(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 0.0]) for i in range(30)] + [(99, None)], POINTS)
    sweep = kmeans_sweep(df, "key", F.col("x"), (2, 3, 5), 2)
    assert [len(sweep.best(k).centres) for k in (2, 3, 5)] == [2, 3, 3]
    assert sweep.best(3).inertia == 0 and [s[2] for s in sweep.scores][1] == 1.0
    one = kmeans_sweep(spark.createDataFrame([(i, [2.0]) for i in range(4)], POINTS), "key", F.col("x"), (2,), 1)
    assert one.scores == [(2, 0.0, None)]
    assert kmeans_sweep(spark.createDataFrame([], POINTS), "key", F.col("x")).runs == []


def test_a_model_has_the_centres_it_is_given(spark):
    centres = np.array([[1.0, 2.0], [3.0, 4.0], [-5.0, 0.5]])
    got = segment_model(spark, centres).clusterCenters()
    assert sorted(map(tuple, got)) == sorted(map(tuple, centres))


@pytest.mark.parametrize("k", [3])
def test_segments_of_vectors(spark, k):
    vectors = table(spark, groups(6, clusters=3)).select("key", array_to_vector("x").alias("pca"))
    found = sweep_segments(vectors, range(2, 5), restarts=3)
    assert found.best_k == 3 and found.model.getK() == 3
    assert np.isclose(found.scores.where("k = 3").first()["inertia"], sum_of_squares(found.model, vectors))
    single = fit_segments(vectors, k, restarts=3)
    assert sorted(np.round(single.clusterCenters(), 6).tolist()) == sorted(np.round(found.model.clusterCenters(), 6).tolist())


def sum_of_squares(model, vectors):
    centres = model.clusterCenters()
    rows = model.transform(vectors).collect()
    return sum(float(((r["pca"].toArray() - centres[r["cluster"]]) ** 2).sum()) for r in rows)


def test_rows_are_read_once_however_many_rounds(spark):
    x = groups(5, n=900)
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    rows = spark.sparkContext.parallelize([(i, [float(v) for v in row]) for i, row in enumerate(x)], 5).map(counted)
    sweep = kmeans_sweep(spark.createDataFrame(rows, POINTS), "key", F.col("x"), range(2, 7), 4)
    assert sweep.scans > 10 and len(x) <= read.value <= 2 * len(x)


def test_starts_of_a_seed_are_the_same_for_every_number_of_clusters(spark):
    sweep = kmeans_sweep(table(spark, groups(6)), "key", F.col("x"), range(2, 6), 3, max_rounds=1, tolerance=1e9, score=False)
    alone = [kmeans_sweep(table(spark, groups(6)), "key", F.col("x"), range(r.k, r.k + 1), 1, r.seed, max_rounds=1, score=False).runs[0] for r in sweep.runs]
    assert all(np.allclose(a.centres, b.centres) and np.isclose(a.inertia, b.inertia) for a, b in zip(sweep.runs, alone, strict=True))


def test_nearest_centres_of_all_runs_are_the_first_of_the_nearest():
    x = np.repeat(groups(7, n=40), 3, axis=0)
    rng = np.random.default_rng(7)
    runs = [x[rng.integers(0, len(x), k)] for k in (1, 2, 2, 5, 3)]
    for own, centres in zip(_nearest(x, runs), runs, strict=True):
        assert (own == ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)).all()


def test_short_tables_of_a_sweep_are_dealt_over_the_cores(spark):
    assert dealt(spark.range(9_000).coalesce(1)).rdd.getNumPartitions() == 2
    assert dealt(spark.range(40_000).coalesce(1)).rdd.getNumPartitions() == 8
    assert dealt(spark.range(100).repartition(4)).rdd.getNumPartitions() == 1
