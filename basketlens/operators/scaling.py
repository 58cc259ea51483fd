"""Median imputation, standard scaling and class weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from basketlens.operators.columns import column_stats
from basketlens.operators.quantiles import exact_quantiles
from basketlens.operators.select import is_missing


def train_medians(train: DataFrame, columns: list[str], test: DataFrame | None = None) -> dict[str, float]:
    """Exact training median of every column with a gap on either side; a column never present gives none."""
    rows = train.select(*columns) if test is None else train.select(*columns).unionByName(test.select(*columns))
    gaps = [c for c, s in column_stats(rows, columns).items() if s.present < s.rows]
    found = exact_quantiles(train, gaps, [0.5])
    return {c: q[0.5] for c, q in found.items() if q[0.5] is not None}


def fill_medians(train: DataFrame, columns: list[str], known: dict[str, float]) -> dict[str, float]:
    """``known`` with the training median of every other column, 0 for one never present.

    Rows that are scored later may have gaps where neither side of the split had any.
    """
    rest = [c for c in columns if c not in known]
    return known | {c: q[0.5] if q[0.5] is not None else 0.0 for c, q in exact_quantiles(train, rest, [0.5]).items()}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    fields = {f.name: f for f in df.schema}
    return df.select(
        *[
            F.when(is_missing(fields[c]), F.lit(float(medians[c]))).otherwise(F.col(c)).cast("double").alias(c)
            if c in medians
            else F.col(c)
            for c in df.columns
        ]
    )


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; a constant column scales to 0."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        stats = {c: (m, s) for c, m, s in zip(self.columns, self.means, self.deviations)}
        return df.select(
            *[
                ((F.col(c).cast("double") - F.lit(stats[c][0])) / F.lit(stats[c][1] or 1.0)).alias(c)
                if c in stats
                else F.col(c)
                for c in df.columns
            ]
        )


def fit_scaler(train: DataFrame, columns: list[str]) -> Scaler:
    stats = column_stats(train, columns)
    return Scaler(
        tuple(columns),
        tuple(stats[c].mean or 0.0 for c in columns),
        tuple(stats[c].deviation or 0.0 for c in columns),
    )


def cell_means(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """Mean over every cell before and after scaling."""

    def mean(df: DataFrame, name: str) -> DataFrame:
        total = sum((F.sum(F.col(c).cast("double")) for c in columns), F.lit(0.0))
        cells = sum((F.count(F.col(c)) for c in columns), F.lit(0))
        return df.agg(F.try_divide(total, cells).alias("mean")).select(F.lit(name).alias("stage"), "mean")

    return mean(before, "before").unionByName(mean(after, "after"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes x class rows) per class; a missing class is a class of its own."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    return counts.select("class", "n", (F.sum("n").over(every) / (F.count("*").over(every) * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, column: str = "weight") -> DataFrame:
    """Attach the balanced weight of the row's class, by a join on the class."""
    weights = class_weights(df, label).select(F.col("class").alias("_class"), F.col("weight").alias("_weight"))
    joined = df.join(weights, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")
    return joined.select(*df.columns, F.col("_weight").alias(column))
