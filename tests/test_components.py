"""Components by triangles: against the library, over many partitions, and odd tables."""

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import functions as F

from basketlens.operators.components import principal_components, residuals, triangle


def table(spark, x, parts=7):
    names = [f"x{i}" for i in range(x.shape[1])]
    return names, spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in names)).repartition(parts)


def test_components_match_the_library(spark):
    rng = np.random.default_rng(1)
    names, df = table(spark, rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) + 10)
    found = principal_components(df, names)
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(df)
    library = PCA(k=6, inputCol="v", outputCol="p").fit(vectors)
    assert np.allclose(found.variances / found.variances.sum(), library.explainedVariance.toArray())
    assert np.allclose(np.abs(found.loadings), np.abs(library.pc.toArray().T))
    assert all(own[np.abs(own).argmax()] > 0 for own in found.loadings)
    cumulated = np.cumsum(library.explainedVariance.toArray())
    assert found.kept(0.9) == int((cumulated <= 0.9).sum()) + 1
    for _, residual, norm in residuals(df, found):
        assert residual < 1e-9 * found.variances[0] and abs(norm - 1) < 1e-12


def test_many_triangles_fold_into_one(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 4))
    names, df = table(spark, x, parts=60)
    r = triangle(df, names, [0.0] * 4)
    assert r.shape == (4, 4) and np.allclose(r.T @ r, x.T @ x)


def test_small_variances_keep_their_digits(spark):
    """Values whose squares would drown the small direction: 1e-9 of the large one's size."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=400) * 1e6, rng.normal(size=400) * 1e-3
    a, b = a - a.mean(), b - b.mean()
    b -= a * (a @ b) / (a @ a)
    names, df = table(spark, np.column_stack([(a + b) / np.sqrt(2), (a - b) / np.sqrt(2)]))
    assert np.allclose(principal_components(df, names).variances, [a @ a / 399, b @ b / 399], rtol=1e-3)


def test_gaps_few_rows_and_none(spark):
    names, df = table(spark, np.array([[1.0, 2.0, 3.0], [2.0, 2.0, 5.0]]))
    gaps = df.unionByName(spark.createDataFrame([(None, 1.0, 2.0), (float("nan"), 0.0, 0.0)], "x0 double, x1 double, x2 double"))
    found = principal_components(gaps, names)
    assert found.rows == 2 and np.allclose(found.variances, [2.5, 0, 0]) and np.allclose(found.loadings @ found.loadings.T, np.eye(3))
    assert found.transform(gaps, (), 1).where("pc1 is null").count() >= 1
    nothing = principal_components(df.where(F.lit(False)), names)
    assert nothing.rows == 0 and not nothing.variances.any() and nothing.kept() == 3
