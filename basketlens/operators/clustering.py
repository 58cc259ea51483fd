"""Distances to centres, cluster reports and the silhouette."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from basketlens.functions.hashing import draw


def centre_distances(values: list[Column], centres: list[list[float]]) -> Column:
    """Euclidean distance to every centre, as one array of plain arithmetic."""

    def distance(centre: list[float]) -> Column:
        return F.sqrt(sum(((v - F.lit(float(c))) * (v - F.lit(float(c))) for v, c in zip(values, centre)), F.lit(0.0)))

    return F.array(*[distance(c) for c in centres])


def nearest_centre(distances: Column) -> Column:
    """Position of the smallest distance, the first on ties."""
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def assign(df: DataFrame, features: list[str], centres: list[list[float]]) -> DataFrame:
    with_distances = df.withColumn("distances", centre_distances([F.col(c).cast("double") for c in features], centres))
    return with_distances.withColumn("cluster", nearest_centre(F.col("distances")))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n"))


def cluster_profiles(df: DataFrame, features: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean of every feature per cluster, three decimals."""
    return df.groupBy(cluster).agg(*[F.bround(F.avg(F.col(c).cast("double")), 3).alias(c) for c in features])


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows with the smallest draws: a sample that does not depend on partitioning."""
    return df.withColumn("_draw", draw(f"sample{seed}", key)).orderBy("_draw", key).limit(n).drop("_draw")


def silhouette(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Mean silhouette of every row with squared Euclidean distances: (clusters, n, silhouette).

    The mean squared distance of a row to a cluster follows from the cluster's size, sum and
    sum of squares: one aggregation and one pass, no pair of rows is compared. Rows alone in
    their cluster count 0; fewer than two clusters have none.
    """
    rows = df.select(F.col(vector).alias("x"), F.col(cluster).cast("int").alias("c"))
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    sizes = rows.groupBy("c").agg(F.count("*").alias("n"), F.sum(norm).alias("q"))
    sums = rows.select("c", F.posexplode("x").alias("i", "v")).groupBy("c", "i").agg(F.sum("v").alias("s"))
    sums = sums.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda e: e["s"]).alias("s"))
    # One row per cluster, as with the centres themselves.
    stats = sizes.join(sums, "c").orderBy("c").collect()

    def mean_distance(k) -> Column:
        mean = F.lit([v / k["n"] for v in k["s"]])
        dot = F.aggregate(F.zip_with("x", mean, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
        return F.greatest(F.col("norm") - 2 * dot + F.lit(k["q"] / k["n"]), F.lit(0.0))

    distances = F.array(*[mean_distance(k) for k in stats]) if stats else F.lit(None).cast("array<double>")
    numbers, counts = ([k[f] for k in stats] for f in ("c", "n"))
    place = F.array_position(F.lit(numbers), F.col("c")).cast("int") - 1 if stats else F.lit(0)
    measured = rows.withColumn("norm", norm).withColumn("d", distances).withColumn("place", place)
    n = F.get(F.lit(counts), F.col("place")) if stats else F.lit(0)
    measured = measured.select(
        n.alias("n"),
        (F.get("d", F.col("place")) * n / F.greatest(n - 1, F.lit(1))).alias("inner"),
        F.array_min(F.filter("d", lambda _, i: i != F.col("place"))).alias("outer"),
    )
    larger = F.greatest("inner", "outer")
    width = F.when((F.col("n") > 1) & (larger > 0), (F.col("outer") - F.col("inner")) / larger).otherwise(0.0)
    return measured.agg(
        F.lit(len(stats)).alias("clusters"),
        F.count("*").alias("n"),
        (F.avg(width) if len(stats) > 1 else F.lit(None).cast("double")).alias("silhouette"),
    )


def sampled_silhouette(
    df: DataFrame, key: str, vector: str, cluster: str, sample_size: int, seed: int = 42
) -> DataFrame:
    """Mean Euclidean silhouette of a sample: (clusters, n, silhouette).

    The sample (at most ``sample_size`` rows, a fixed bound) is shared with the
    tasks, which compute each row's mean distance to every cluster. Samples with
    fewer than two clusters have none.
    """
    sample = hash_sample(df.select(key, F.col(vector).alias("x"), F.col(cluster).cast("int").alias("c")), key, sample_size, seed)
    rows = sample.toPandas()
    schema = "clusters int, n bigint, silhouette double"
    labels, sizes = np.unique(rows["c"].to_numpy(), return_counts=True)
    spark = df.sparkSession
    if len(labels) < 2:
        return spark.createDataFrame([(len(labels), len(rows), None)], schema)
    shared = spark.sparkContext.broadcast((np.stack(rows["x"].to_numpy()).astype(float), rows["c"].to_numpy(), labels, sizes))

    def widths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, member, classes, counts = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x, own = np.stack(batch["x"].to_numpy()).astype(float), np.searchsorted(classes, batch["c"].to_numpy())
            distance = np.sqrt(sum((x[:, j, None] - points[None, :, j]) ** 2 for j in range(x.shape[1])))
            totals = np.stack([distance[:, member == c].sum(1) for c in classes], axis=1)
            at = np.arange(len(x))
            inner = totals[at, own] / np.maximum(counts[own] - 1, 1)
            means = totals / counts
            means[at, own] = np.inf
            outer = means.min(1)
            larger = np.maximum(inner, outer)
            width = np.where((counts[own] > 1) & (larger > 0), (outer - inner) / np.where(larger > 0, larger, 1.0), 0.0)
            yield pd.DataFrame({"width": width})

    return sample.select("x", "c").mapInPandas(widths, "width double").agg(
        F.lit(len(labels)).alias("clusters"), F.count("*").alias("n"), F.avg("width").alias("silhouette")
    )


def best_k(scores: DataFrame) -> DataFrame:
    """(k, silhouette) with the largest silhouette, the smallest k on ties."""
    return scores.orderBy(F.desc("silhouette"), "k").limit(1)
