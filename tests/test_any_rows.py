"""Repeated, text and missing keys, missing classes, wide numbers and gaps lose or double nothing."""

import collections
import math
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators.clustering import silhouette
from basketlens.operators.neighbours import nearest_neighbours
from basketlens.operators.quantiles import exact_quantiles
from basketlens.operators.scaling import class_weights, with_class_weight
from basketlens.operators.smote import smote
from basketlens.operators.split import random_split, stratified_split
from basketlens.sources.customers import read_customers_csv, unreadable_cells

ROOT = Path(__file__).resolve().parents[1]


# --- quantiles ------------------------------------------------------------------------


@pytest.mark.parametrize("fetch_rows", [1, 10_000])
@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, math.inf, -math.inf, 3.0, math.inf],
        [-1.7e308, 1.7e308, 1.0, 2.0, -5.0],
        [5e-324, 1e-323, 1.5e-323, 0.0, 2e-323],
        [10.0**e for e in range(-300, 300, 7)],
        [-(10.0**e) for e in range(-300, 300, 7)] + [0.0] * 5 + [10.0**e for e in range(-300, 300, 9)],
        [math.inf] * 4,
    ],
)
def test_quantiles_end_on_any_numbers(spark, values, fetch_rows):
    rows = sorted(values)
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double")
    for p, got in exact_quantiles(df, ["v"], [0.0, 0.3, 0.5, 1.0], fetch_rows)["v"].items():
        place = p * (len(rows) - 1)
        low, high = rows[math.floor(place)], rows[min(math.floor(place) + 1, len(rows) - 1)]
        f = place - math.floor(place)
        if low == high or f == 0:
            assert got == low
        elif math.isinf(low) or math.isinf(high):
            assert math.isinf(got) or math.isnan(got)
        else:
            assert got == pytest.approx(low * (1 - f) + high * f, rel=1e-9)


# --- splits ---------------------------------------------------------------------------


@pytest.mark.parametrize("literal_strata", [0, 64])
def test_split_of_repeated_keys_and_missing_classes(spark, literal_strata):
    rows = [(i % 101 if i % 13 else None, None if i % 5 == 0 else f"c{i % 3}") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, y string")
    got = stratified_split(df, "y", "k", literal_strata=literal_strata).collect()
    assert collections.Counter((r["k"], r["y"]) for r in got) == collections.Counter(rows)
    sides = collections.defaultdict(set)
    for r in got:
        sides[r["k"]].add(r["split"])
    assert all(len(s) == 1 for s in sides.values())
    assert sum(s == {"test"} for s in sides.values()) == math.ceil(0.2 * len(sides))


def test_split_with_mostly_missing_classes_and_many_classes(spark):
    missing = spark.createDataFrame([(i, None if i % 5 else 1) for i in range(25_000)], "k long, y int")
    got = stratified_split(missing, "y", "k").groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in got} == {(None, "test"): 4000, (None, "train"): 16000, (1, "test"): 1000, (1, "train"): 4000}
    many = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 200).alias("y"))
    tests = stratified_split(many, "y", "k").where("split = 'test'").groupBy("y").count().collect()
    assert [r["count"] for r in tests] == [4] * 200
    text = random_split(spark.createDataFrame([(f"k{i % 50}",) for i in range(1000)], "k string"), "k")
    assert text.where("split = 'test'").select("k").distinct().count() == 10


# --- oversampling ---------------------------------------------------------------------


@pytest.mark.parametrize("key", ["long", "string"])
def test_smote_with_repeated_and_missing_keys(spark, key):
    rng = np.random.default_rng(1)
    rows = [(i, 0, *rng.normal(size=2).tolist()) for i in range(40)]
    rows += [(100 + i % 5 if i else None, 1, *rng.normal(size=2).tolist()) for i in range(10)]
    rows += [(200, None, 0.0, 0.0)] * 3
    df = spark.createDataFrame(rows, "k long, y int, a double, b double").withColumn("k", F.col("k").cast(key))
    out = smote(df, ["a", "b"], "y", "k").collect()
    assert collections.Counter(r["y"] for r in out) == {0: 40, 1: 40, None: 3}
    made = [(r["k"], r["copy"]) for r in out if r["copy"] > 0]
    assert len(made) == len(set(made)) == 30
    inside = [(min(r[3] for r in rows if r[1] == 1), max(r[3] for r in rows if r[1] == 1))]
    assert all(inside[0][0] <= r["b"] <= inside[0][1] for r in out if r["copy"] > 0)


def test_approximate_smote_is_balanced(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i < 60), *rng.normal(size=2).tolist()) for i in range(300)]
    out = smote(spark.createDataFrame(rows, "k long, y int, a double, b double"), ["a", "b"], "y", "k", cell_rows=4, trees=2)
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 240, 1: 240}


def test_smote_of_many_identical_rows(spark):
    df = spark.range(3000).select(
        F.lit("same").alias("k"), (F.col("id") < 1000).cast("int").alias("y"), F.lit(1.0).alias("a"), (F.col("id") % 2).cast("double").alias("b")
    )
    out = smote(df, ["a", "b"], "y", "k")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 2000, 1: 2000}
    assert out.where("copy > 0").select("k", "copy").distinct().count() == 1000


def test_neighbours_of_text_keys(spark):
    points = spark.createDataFrame([(k, [float(x), 0.0]) for k, x in (("b", 0), ("a", 1), ("c", 3), ("d", 3))], "key string, vec array<double>")
    distinct, found = nearest_neighbours(points, 1)
    vectors = {r["rep"]: tuple(r["vec"]) for r in distinct.collect()}
    assert {(vectors[r["rep"]], tuple(r["neighbour"])) for r in found.collect()} == {
        ((0.0, 0.0), (1.0, 0.0)), ((1.0, 0.0), (0.0, 0.0)), ((3.0, 0.0), (3.0, 0.0)),
    }


def test_approximate_neighbours_have_bounded_work_and_good_recall(spark):
    rng = np.random.default_rng(3)
    recall = {}
    for rows in (500, 4000):
        x = rng.normal(size=(rows, 20)) * np.linspace(3, 0.3, 20)
        points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "key long, vec array<double>")
        distinct, found = nearest_neighbours(points, 5, cell_rows=250, trees=10)
        vectors = {r["rep"]: r["vec"] for r in distinct.collect()}
        right = total = 0
        by_rep = collections.defaultdict(list)
        for r in found.collect():
            by_rep[r["rep"]].append(r)
        assert len(by_rep) == rows and all(len(v) == 5 for v in by_rep.values())
        for rep in list(by_rep)[:200]:
            own = np.array(vectors[rep])
            near = np.sort(((x - own) ** 2).sum(1))[1:6]
            got = sorted(r["distance"] ** 2 for r in by_rep[rep])
            right += sum(g <= near[-1] * (1 + 1e-9) for g in got)
            total += 5
        recall[rows] = right / total
    # Ten cells of at most 250 rows are looked at per row, whatever the table.
    assert recall[500] > 0.95 and recall[4000] > 0.6, recall


# --- weights, silhouette, csv ---------------------------------------------------------


def test_class_weights_join_missing_classes(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "y int")
    assert {r["class"]: r["weight"] for r in class_weights(df, "y").collect()} == pytest.approx({1: 4 / 6, None: 4 / 3, 2: 4 / 3})
    assert with_class_weight(df, "y").where("weight is null").count() == 0


def test_silhouette_of_every_row(spark):
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(300, 3)), rng.integers(0, 4, 300)
    c[0] = 9  # alone
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    widths = []
    for i in range(300):
        own = c == c[i]
        if own.sum() == 1:
            widths.append(0.0)
            continue
        inner = d[i, own].sum() / (own.sum() - 1)
        outer = min(d[i, c == k].mean() for k in set(c) - {c[i]})
        widths.append((outer - inner) / max(inner, outer))
    df = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, c, strict=True)], "x array<double>, c int")
    row = silhouette(df, "x", "c").first()
    assert (row["clusters"], row["n"]) == (5, 300) and row["silhouette"] == pytest.approx(np.mean(widths))
    assert silhouette(df.where("c = 1"), "x", "c").first()["silhouette"] is None
    assert silhouette(df.where("c = 77"), "x", "c").first()["n"] == 0


def test_csv_keeps_whole_numbers_with_decimals(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("CustomerID,Frequency,Recency,MonetaryTotal,Gender,Extra\n1,5.0,12.0,3.5,F,x\n9007199254740993,7,,NaN,,y\n3,2.5,word,-1e3,M,\n")
    got = {r["CustomerID"]: r for r in read_customers_csv(spark, str(path)).collect()}
    assert (got[1]["Frequency"], got[1]["Recency"], got[1]["MonetaryTotal"]) == (5, 12, 3.5)
    assert got[9007199254740993]["Frequency"] == 7 and got[9007199254740993]["MonetaryTotal"] is None
    assert got[3]["Frequency"] is None and got[3]["MonetaryTotal"] == -1000.0
    assert {r["column"]: r["cells"] for r in unreadable_cells(spark, str(path)).collect()} == {"Frequency": 1, "Recency": 1}


def test_workers_find_the_package_from_another_folder(tmp_path):
    """A session started elsewhere, without PYTHONPATH, runs an operator with Python tasks."""
    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from basketlens.operators.neighbours import nearest_neighbours
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
points = spark.createDataFrame([(i, [float(i)]) for i in range(5)], "key long, vec array<double>")
print("found", nearest_neighbours(points, 1)[1].count())
"""
    )
    import os

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found 5" in run.stdout, run.stderr[-2000:]
