"""Principal components by tall-skinny QR: no product of features x features is ever summed.

Every task folds its centred rows into one triangular matrix; the triangles are folded by
groups until one is left. It has the singular values and right vectors of the whole table, to
the precision of the values themselves rather than of their squares.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.shipping import map_batches
from basketlens.staging import stage

#: Triangles folded together by a task.
FAN_IN = 16
TRIANGLES = "block long, place int, row array<double>"


@dataclass(frozen=True)
class Components:
    """``loadings[c]`` are the weights of the features in component c; its largest one (by size) is positive."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    variances: np.ndarray
    loadings: np.ndarray
    rows: int

    def kept(self, share: float = 0.95) -> int:
        """The first components whose cumulated variance exceeds ``share``, all if none does."""
        total = self.variances.sum()
        if total <= 0:
            return len(self.variances)
        return min(int(np.searchsorted(np.cumsum(self.variances) / total, share, side="right")) + 1, len(self.variances))

    def curve(self, spark: SparkSession, share: float = 0.95) -> DataFrame:
        """(component, variance, share, cumulative, kept)."""
        total, kept = self.variances.sum(), self.kept(share)
        shares = self.variances / total if total > 0 else np.zeros(len(self.variances))
        rows = [
            (i + 1, float(v), float(s), float(c), i < kept) for i, (v, s, c) in enumerate(zip(self.variances, shares, np.cumsum(shares), strict=True))
        ]
        return spark.createDataFrame(rows, "component int, variance double, share double, cumulative double, kept boolean")

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c + 1, f, float(v)) for c, own in enumerate(self.loadings) for f, v in zip(self.features, own, strict=True)]
        return spark.createDataFrame(rows, "component int, feature string, loading double")

    def transform(self, df: DataFrame, keep: tuple[str, ...], count: int) -> DataFrame:
        """``keep`` and the first ``count`` components as pc1, pc2, ...; null where a feature is missing."""
        centred = [F.col(f).cast("double") - F.lit(m) for f, m in zip(self.features, self.means, strict=True)]
        scores = [
            sum((x * F.lit(float(w)) for x, w in zip(centred, own, strict=True)), F.lit(0.0)).alias(f"pc{c + 1}")
            for c, own in enumerate(self.loadings[:count])
        ]
        return df.select(*keep, *scores)


def _fold(held: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if held is None else np.vstack([held, rows]), mode="r")


def _rows(block: int, triangle: np.ndarray) -> pa.RecordBatch:
    n = len(triangle)
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(list(triangle), pa.list_(pa.float64()))],
        names=["block", "place", "row"],
    )


def _triangles(means: np.ndarray):
    def run(batches):
        held, part = None, 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1) - means
                for start in range(0, len(x), 4096):
                    held = _fold(held, x[start : start + 4096])
        if held is not None:
            yield _rows(part, held)

    return run


def _folded(batches):
    """Triangles come sorted by the group they are folded into."""
    group, held = None, None
    for batch in batches:
        groups, lists = batch.column(0).to_numpy(), batch.column(1)
        x = lists.flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 0))
        cuts = np.flatnonzero(np.diff(groups)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(groups)], strict=True):
            if a == b:
                continue
            if groups[a] != group:
                if held is not None:
                    yield _rows(int(group), held)
                group, held = groups[a], None
            held = _fold(held, x[a:b])
    if held is not None:
        yield _rows(int(group), held)


def triangle(df: DataFrame, features: list[str], means: list[float]) -> np.ndarray:
    """R of the centred rows without gaps; empty for none."""
    values = F.array(*[F.col(f).cast("double") for f in features])
    rows = df.where(F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v)))
    rows = rows.select(F.spark_partition_id().cast("long").alias("part"), values.alias("x"))
    folded = stage(map_batches(rows, _triangles(np.array(means)), TRIANGLES), "triangles")
    while folded.agg(F.countDistinct("block")).first()[0] > 1:
        groups = folded.select(F.floor(F.col("block") / FAN_IN).cast("long").alias("group"), "row", "block", "place")
        ordered = groups.repartition("group").sortWithinPartitions("group", "block", "place").select("group", "row")
        folded = stage(map_batches(ordered, _folded, TRIANGLES), "triangles")
    found = [r["row"] for r in folded.orderBy("place").collect()]
    return np.array(found, dtype=float).reshape(len(found), len(features))


def principal_components(df: DataFrame, features: list[str]) -> Components:
    """All components of the rows without gaps; a table without such rows has variances of 0.

    Two scans: the means, then the triangles. Components of equal variance may be any pair of
    directions in their plane.
    """
    numbers = [F.col(f).cast("double") for f in features]
    whole = df.where(F.forall(F.array(*numbers), lambda v: v.isNotNull() & ~F.isnan(v)))
    first = whole.agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(numbers)]).first()
    n, means = first["n"], [first[f"m{i}"] or 0.0 for i in range(len(features))]
    r = triangle(whole, features, means)
    d = len(features)
    padded = np.zeros((max(d, len(r)), d))
    padded[: len(r)] = r
    _, values, loadings = np.linalg.svd(padded, full_matrices=False)
    largest = loadings[np.arange(d), np.abs(np.round(loadings, 9)).argmax(1)]
    return Components(tuple(features), tuple(means), values**2 / max(n - 1, 1), loadings * np.where(largest < 0, -1.0, 1.0)[:, None], n)


def residuals(df: DataFrame, found: Components) -> list[tuple[int, float, float]]:
    """(component, |C v - variance v|, |v|) with C from the rows, one scan: C v is the mean of (x . v) x."""
    centred = [F.col(f).cast("double") - F.lit(m) for f, m in zip(found.features, found.means, strict=True)]
    rows = df.where(F.forall(F.array(*[F.col(f).cast("double") for f in found.features]), lambda v: v.isNotNull() & ~F.isnan(v)))
    sums = []
    for c, own in enumerate(found.loadings):
        score = sum((x * F.lit(float(w)) for x, w in zip(centred, own, strict=True)), F.lit(0.0))
        sums += [(F.sum(score * x) / F.lit(max(found.rows - 1, 1))).alias(f"c{c}_{i}") for i, x in enumerate(centred)]
    row = rows.agg(*sums).first()
    out = []
    for c, own in enumerate(found.loadings):
        image = np.array([row[f"c{c}_{i}"] or 0.0 for i in range(len(own))])
        out.append((c + 1, float(np.linalg.norm(image - found.variances[c] * own)), float(np.linalg.norm(own))))
    return out
