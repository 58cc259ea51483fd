"""Whole-table profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from basketlens.functions.cleaning import VALID_RANGES
from basketlens.operators.quantiles import exact_quantiles
from basketlens.operators.select import is_missing, missing_profile, numeric_columns
from basketlens.sources.customers import TARGET


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def type_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type; from the schema, without a job."""
    names = [f.dataType.simpleString() for f in df.schema]
    return df.sparkSession.createDataFrame(
        sorted((n, names.count(n)) for n in set(names)), "type string, columns int"
    )


def top_missing(df: DataFrame, n: int = 10) -> DataFrame:
    """Columns with missing values, most first."""
    return missing_profile(df).where(F.col("missing") > 0).orderBy(F.desc("missing"), "column").limit(n)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical group; copies are combined before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column."""
    columns = columns or numeric_columns(df)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    fields = {f.name: f for f in df.schema}

    def present(c):
        return F.when(~is_missing(fields[c]), F.col(c)).cast("double")

    row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(present(c)).alias("count"),
                F.avg(present(c)).alias("mean"),
                F.when(F.count(present(c)) > 1, F.stddev_samp(present(c))).alias("std"),
                F.min(present(c)).alias("min"),
                *[F.lit(quartiles[c][p]).cast("double").alias(n) for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))],
                F.max(present(c)).alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return row.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))


def class_distribution(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Count and share per class, classes in order."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())  # over one row per class
    return counts.select(F.col(label).alias("class"), "n", share.alias("share")).orderBy("class")


def target_rates(df: DataFrame, label: str = TARGET, by: str = "split") -> DataFrame:
    """Rows, positives and positive rate per side."""
    return df.groupBy(by).agg(
        F.count("*").alias("n"),
        F.sum(F.col(label).cast("long")).alias("positives"),
        F.avg(F.col(label).cast("double")).alias("rate"),
    )


def balance(before: DataFrame, after: DataFrame, label: str = TARGET) -> DataFrame:
    """Class counts and shares before and after oversampling."""
    sides = [class_distribution(df, label).withColumn("stage", F.lit(n)) for n, df in (("before", before), ("after", after))]
    return sides[0].unionByName(sides[1]).select("stage", "class", "n", "share")


def outlier_counts(df: DataFrame, quantiles: dict[float, float] | None = None) -> DataFrame:
    """How many values each cleaning rule sets to missing or clips.

    The satisfaction rule counts what lies outside its range, missing values included; the
    ticket rule counts values below or above only.
    """
    rules = {}
    for column, (low, high) in VALID_RANGES.items():
        if column in df.columns:
            outside = ~F.col(column).between(low, high)
            missing = F.lit(column == "SatisfactionScore")
            rules[f"{column} outside [{low}, {high}]"] = F.coalesce(outside, missing)
    if quantiles and "MonetaryTotal" in df.columns:
        rules["MonetaryTotal clipped"] = ~F.col("MonetaryTotal").between(quantiles[0.01], quantiles[0.99])
    row = df.agg(*[F.count_if(mask).alias(f"r{i}") for i, mask in enumerate(rules.values())])
    return row.select(
        F.inline(
            F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n")) for i, name in enumerate(rules)])
        )
    )


def load_and_inspect(df: DataFrame) -> DataFrame:
    """The profile in one long table: (section, name, value)."""

    def long(part: DataFrame, section: str, name, value) -> DataFrame:
        return part.select(F.lit(section).alias("section"), name.alias("name"), value.cast("double").alias("value"))

    size = shape(df)
    return (
        long(size, "shape", F.lit("rows"), F.col("rows"))
        .unionByName(long(size, "shape", F.lit("columns"), F.col("columns")))
        .unionByName(long(type_counts(df), "types", F.col("type"), F.col("columns")))
        .unionByName(long(top_missing(df), "missing", F.col("column"), F.col("missing")))
        .unionByName(long(duplicate_rows(df), "duplicates", F.lit("rows"), F.col("duplicates")))
    )
