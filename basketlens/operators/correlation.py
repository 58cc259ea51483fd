"""Pearson correlation of many columns from one product-sum pass.

Missing values are left out pair by pair. Every column is standardised by its own
mean and deviation; a column with gaps adds a 0/1 presence column, and all columns
their square, so that the sums of products of that widened vector hold everything
a pairwise correlation needs. The result is a features x features matrix, whatever
the number of rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from basketlens.operators.columns import column_stats, present
from basketlens.operators.select import numeric_columns

PAIR_SCHEMA = "feature_1 string, feature_2 string, correlation double"


def correlation_matrix(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Pairwise r in the order of ``columns``; NaN where a side is constant or never present."""
    d = len(columns)
    stats = column_stats(df, columns)
    gaps = [i for i, c in enumerate(columns) if stats[c].present < stats[c].rows]
    unit = [(present(c) - F.lit(stats[c].mean or 0.0)) / F.lit(stats[c].deviation or 1.0) for c in columns]
    wide = [F.coalesce(u, F.lit(0.0)).alias(f"x{i}") for i, u in enumerate(unit)]
    if gaps:
        wide += [F.coalesce(u * u, F.lit(0.0)).alias(f"q{i}") for i, u in enumerate(unit)]
        wide += [F.when(present(columns[i]).isNotNull(), 1.0).otherwise(0.0).alias(f"p{i}") for i in gaps]
        wide.append(F.lit(1.0).alias("one"))
    table = df.select(*wide)
    vectors = VectorAssembler(inputCols=table.columns, outputCol="v").transform(table).select("v")
    sums = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeGramianMatrix().toArray()

    x, q = np.arange(d), d + np.arange(d)
    sum_xy = sums[np.ix_(x, x)]
    if gaps:
        presence = np.full(d, 2 * d + len(gaps))
        presence[gaps] = 2 * d + np.arange(len(gaps))
        n = sums[np.ix_(presence, presence)]
        sum_x = sums[np.ix_(x, presence)]  # x_i over the rows where j is present
        sum_xx = sums[np.ix_(q, presence)]
    else:
        # Standardised columns without gaps: the sums are 0 and the squares add up to the rows.
        n = np.full((d, d), float(stats[columns[0]].rows))
        sum_x, sum_xx = np.zeros((d, d)), n
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = sum_x / n
        cov = sum_xy / n - mean * mean.T
        var = sum_xx / n - mean * mean
        floor = 1e-12 * np.maximum(1.0, sum_xx / n)  # constant up to rounding
        var = np.where(var > floor, var, np.nan)
        r = cov / np.sqrt(var * var.T)
    constant = np.array([not stats[c].deviation for c in columns])
    r[constant, :] = np.nan
    r[:, constant] = np.nan
    return np.clip(r, -1.0, 1.0)


def correlation_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Lower triangle in long form: (feature_1, feature_2, r), feature_2 before feature_1."""
    columns = columns or numeric_columns(df)
    r = correlation_matrix(df, columns)
    rows = [
        (columns[i], columns[j], None if math.isnan(r[i, j]) else float(r[i, j]))
        for i in range(len(columns))
        for j in range(i)
    ]
    return df.sparkSession.createDataFrame(rows, PAIR_SCHEMA)


def high_correlation_pairs(df: DataFrame, threshold: float = 0.8, columns: list[str] | None = None) -> DataFrame:
    """Pairs with |r| at or above the threshold, strongest first; empty when there is none."""
    columns = columns or numeric_columns(df)
    r = np.abs(correlation_matrix(df, columns))
    rows = [
        (columns[i], columns[j], float(np.round(r[i, j], 4)))
        for i in range(len(columns))
        for j in range(i + 1, len(columns))
        if not math.isnan(r[i, j]) and r[i, j] >= threshold
    ]
    pairs = df.sparkSession.createDataFrame(rows, PAIR_SCHEMA)
    return pairs.orderBy(F.desc("correlation"), "feature_1", "feature_2")


def correlated_columns(df: DataFrame, columns: list[str], threshold: float = 0.85) -> list[str]:
    """Columns that correlate above the threshold with any column before them, dropped or not."""
    r = np.abs(correlation_matrix(df, columns))
    return [c for j, c in enumerate(columns) if any(not math.isnan(v) and v > threshold for v in r[:j, j])]
