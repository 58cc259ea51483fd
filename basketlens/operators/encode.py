"""Label encoding of text columns with a kept mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.functions.cleaning import category_text, to_number_or_zero
from basketlens.operators.ordering import running_totals
from basketlens.operators.select import text_columns
from basketlens.staging import stage


def fit_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mapping (column, value, code): codes 0..n-1 in code-point order of the values.

    All columns share one aggregation. Ranks come from range slices, so a column
    with very many values is not numbered in one task.
    """
    schema = "column string, value string, code int"
    if not columns:
        return df.sparkSession.createDataFrame([], schema)
    values = (
        df.select(
            F.inline(
                F.array(*[F.struct(F.lit(c).alias("column"), category_text(F.col(c)).alias("value")) for c in columns])
            )
        )
        .distinct()
        .withColumn("one", F.lit(1))
    )
    numbered = running_totals(values, [F.col("value")], {"position": "one"}, groups=("column",))
    return stage(numbered.select("column", "value", (F.col("position") - 1).cast("int").alias("code")), "labels")


def apply_labels(df: DataFrame, mapping: DataFrame, columns: list[str], unseen: int = 0) -> DataFrame:
    """Replace text by its code; a value the mapping lacks gets ``unseen``.

    The mapping side carries no hint: Spark broadcasts it when it is small.
    """
    out = df
    for c in columns:
        codes = mapping.where(F.col("column") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}")
        )
        out = out.join(codes, category_text(out[c]) == F.col(f"_v_{c}"), "left")
    return out.select(
        *[F.coalesce(F.col(f"_c_{c}"), F.lit(unseen)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def encode_pair(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fit on train, apply to both sides."""
    columns = text_columns(train)
    mapping = fit_labels(train, columns)
    return apply_labels(train, mapping, columns), apply_labels(test, mapping, columns), mapping


def encode_and_clean(df: DataFrame, mapping: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode with a kept mapping, then every column as a number with 0 for what is none."""
    coded = apply_labels(df, mapping, columns)
    return coded.select(*keep, *[to_number_or_zero(F.col(c)).alias(c) for c in coded.columns if c not in keep])
