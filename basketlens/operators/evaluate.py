"""Evaluation of classifiers and regressors by aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.functions.risk import decide
from basketlens.operators.ordering import running_totals
from basketlens.staging import stage


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        F.avg((F.col(actual) == F.col(predicted)).cast("int").cast("double")).alias("accuracy"),
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Every (actual, predicted) cell of the class grid; empty ones are 0."""
    cells = [(a, p) for a in classes for p in classes]
    row = df.agg(
        *[F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"c{i}") for i, (a, p) in enumerate(cells)]
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{i}").alias("n"))
                    for i, (a, p) in enumerate(cells)
                ]
            )
        )
    )


def class_report(df: DataFrame, actual: str, predicted: str, classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    a, p = F.col(actual), F.col(predicted)
    row = df.agg(
        F.count("*").alias("total"),
        F.count_if(a == p).alias("right"),
        *[
            e.alias(f"{n}{c}")
            for c in classes
            for n, e in (
                ("tp", F.count_if((a == c) & (p == c))),
                ("said", F.count_if(p == c)),
                ("have", F.count_if(a == c)),
            )
        ],
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    measures = {}
    for c in classes:
        precision = ratio(F.col(f"tp{c}"), F.col(f"said{c}"))
        recall = ratio(F.col(f"tp{c}"), F.col(f"have{c}"))
        f1 = ratio(F.col(f"tp{c}") * 2, F.col(f"said{c}") + F.col(f"have{c}"))
        measures[c] = (precision, recall, f1, F.col(f"have{c}"))
    total = F.col("total")
    hit = ratio(F.col("right"), total)
    lines = [(str(c), *m) for c, m in measures.items()]
    lines.append(("accuracy", hit, hit, hit, total))
    lines.append(("macro avg", *[sum(m[i] for m in measures.values()) / len(classes) for i in range(3)], total))
    lines.append(("weighted avg", *[ratio(sum(m[i] * m[3] for m in measures.values()), total) for i in range(3)], total))
    names = ("precision", "recall", "f1", "support")
    return row.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(l[0]).alias("class"), *[e.alias(n) for n, e in zip(names, l[1:])]) for l in lines]
            )
        )
    )


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, and how many are at or above it."""
    tied = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return running_totals(tied, [F.col("score").desc()], {"tp": "pos", "fp": "neg"})


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr): the origin, then every distinct score from the highest; one table row per score."""
    points = stage(_by_score(df, label, score), "roc")
    totals = points.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    curve = points.select(
        F.col("score").cast("double").alias("threshold"),
        F.try_divide("fp", F.lit(totals["n"])).alias("fpr"),
        F.try_divide("tp", F.lit(totals["p"])).alias("tpr"),
    )
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], curve.schema)
    return origin.unionByName(curve)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL when a class is absent."""
    positives, negatives = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    pairs_won = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2))
    return _by_score(df, label, score).agg(
        F.try_divide(pairs_won, positives * negatives).alias("auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def auc_gap(train: DataFrame, test: DataFrame, label: str, score: str) -> DataFrame:
    """Train AUC, test AUC and their difference."""
    values = [roc_auc(side, label, score).select("auc") for side in (train, test)]
    both = values[0].select(F.col("auc").alias("train_auc"), F.lit(None).cast("double").alias("test_auc")).unionByName(
        values[1].select(F.lit(None).cast("double").alias("train_auc"), F.col("auc").alias("test_auc"))
    )
    one = both.agg(F.max("train_auc").alias("train_auc"), F.max("test_auc").alias("test_auc"))
    return one.withColumn("gap", F.col("train_auc") - F.col("test_auc"))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    y, residual = F.col(actual), F.col(actual) - F.col(predicted)
    return df.where(y.isNotNull() & F.col(predicted).isNotNull()).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(residual)).alias("mae"),
        F.sqrt(F.avg(residual * residual)).alias("rmse"),
        (1 - F.try_divide(F.sum(residual * residual), F.var_pop(y) * F.count("*"))).alias("r2"),
    )


def residuals(df: DataFrame, key: str, actual: str, predicted: str) -> DataFrame:
    return df.select(key, (F.col(actual) - F.col(predicted)).alias("residual"))


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 40) -> DataFrame:
    """Counts of equal-width bins from the smallest to the largest residual, empty bins included."""
    table = df.select((F.col(actual) - F.col(predicted)).alias("r")).where(F.col("r").isNotNull())
    span = table.agg(F.min("r").alias("lo"), F.max("r").alias("hi")).first()
    low, high = span["lo"], span["hi"]
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    position = F.least(F.floor((F.col("r") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = table.groupBy(position.alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def residual_range(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Largest absolute value of truth and prediction: the symmetric plot limit."""
    return df.agg(F.greatest(F.max(F.abs(actual)), F.max(F.abs(predicted))).alias("limit"))


def with_decision(df: DataFrame, score: str, actual: str) -> DataFrame:
    """Class decision and whether it is right."""
    return df.withColumn("predicted", decide(F.col(score))).withColumn("correct", F.col("predicted") == F.col(actual))
