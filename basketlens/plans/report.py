"""Summary tables over scored customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.functions.risk import is_high_risk, risk_rank
from basketlens.operators.quantiles import exact_quantiles


def high_risk_share(df: DataFrame, level: str = "risk_level") -> DataFrame:
    """How many customers are at high risk, and their share."""
    return df.agg(
        F.count_if(is_high_risk(F.col(level))).alias("high_risk"),
        F.try_divide(F.count_if(is_high_risk(F.col(level))), F.count("*")).alias("share"),
    )


def _distribution(df: DataFrame, column: str, kind: str, prefix: str = "") -> DataFrame:
    total = df.agg(F.count("*").alias("n")).first()["n"]
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.select(
        F.lit(kind).alias("kind"),
        F.concat(F.lit(prefix), F.col(column).cast("string")).alias("name"),
        "n",
        F.round(F.col("n") / F.lit(total) * 100, 1).alias("percent"),
    )


def risk_distribution(df: DataFrame, level: str = "risk_level") -> DataFrame:
    return _distribution(df, level, "risk").orderBy(risk_rank(F.col("name")))


def segment_distribution(df: DataFrame, segment: str = "segment") -> DataFrame:
    return _distribution(df, segment, "segment", "Cluster ").orderBy("name")


def dashboard_kpis(df: DataFrame, predicted: str = "churn_predicted") -> DataFrame:
    return df.agg(
        F.count("*").alias("clients"),
        F.sum(F.col(predicted).cast("long")).alias("churned"),
        F.round(F.avg(F.col(predicted).cast("double")) * 100, 1).alias("churn_rate"),
    )


def prediction_summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, exact median, smallest and largest prediction."""
    median = exact_quantiles(df, [column], [0.5])[column][0.5]
    return df.agg(
        F.avg(column).alias("mean"),
        F.lit(median).cast("double").alias("median"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
