"""Choosing, dropping and aligning columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketlens.sources.customers import KEY, LEAKAGE_COLUMNS, TARGET


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def is_missing(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _per_column(df: DataFrame, measures: dict[str, callable], exempt: tuple[str, ...]) -> DataFrame:
    """One row per column from a single aggregate over the table."""
    fields = [f for f in df.schema if f.name not in exempt]
    row = df.agg(
        F.count("*").alias("rows"),
        *[m(f).alias(f"{name}_{i}") for i, f in enumerate(fields) for name, m in measures.items()],
    )
    return row.select(
        "rows",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f.name).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in measures])
                    for i, f in enumerate(fields)
                ]
            )
        ),
    )


def _present(f: T.StructField) -> Column:
    return F.when(~is_missing(f), F.col(f.name))


_CONSTANT = {
    "present": lambda f: F.count(_present(f)),
    "single": lambda f: F.coalesce(F.min(_present(f)) == F.max(_present(f)), F.lit(True)),
}


def _is_constant() -> Column:
    return (F.col("present") == 0) | ((F.col("present") == F.col("rows")) & F.col("single"))


def constant_profile(df: DataFrame, exempt: tuple[str, ...] = (TARGET,)) -> DataFrame:
    """(column, is_constant): one distinct value, a missing value counting as one.

    The smallest and largest value decide, so no distinct set is built.
    """
    return _per_column(df, _CONSTANT, exempt).select("column", _is_constant().alias("is_constant"))


def constant_columns(df: DataFrame, exempt: tuple[str, ...] = (TARGET,)) -> list[str]:
    return [r["column"] for r in constant_profile(df, exempt).where("is_constant").collect()]


def missing_profile(df: DataFrame, exempt: tuple[str, ...] = ()) -> DataFrame:
    """(column, missing, share) for every column."""
    profile = _per_column(df, {"missing": lambda f: F.count_if(is_missing(f))}, exempt)
    return profile.select("column", "missing", F.try_divide("missing", "rows").alias("share"))


def high_missing_columns(df: DataFrame, threshold: float = 0.5, exempt: tuple[str, ...] = (TARGET,)) -> list[str]:
    """Columns whose missing share is strictly above the threshold."""
    return [r["column"] for r in missing_profile(df, exempt).where(F.col("share") > threshold).collect()]


def useless_columns(df: DataFrame, threshold: float = 0.5, exempt: tuple[str, ...] = (TARGET,)) -> tuple[list[str], list[str]]:
    """Constant columns and columns missing too often, from one aggregate."""
    share = F.try_divide(F.col("rows") - F.col("present"), F.col("rows"))
    found = _per_column(df, _CONSTANT, exempt).select("column", _is_constant().alias("c"), (share > threshold).alias("m"))
    rows = found.collect()
    return [r["column"] for r in rows if r["c"]], [r["column"] for r in rows if r["m"]]


def drop_useless(df: DataFrame, constant: list[str], keep_key: bool = False) -> DataFrame:
    """Drop constant, identifier and leakage columns; the key may stay as metadata."""
    ids = () if keep_key else (KEY,)
    return df.drop(*[c for c in constant if not (keep_key and c == KEY)], *ids, *LEAKAGE_COLUMNS)


def guard_features(features: list[str], target: str = TARGET) -> list[str]:
    """Refuse the target among the features; leave residual leakage columns out."""
    if target in features:
        raise ValueError(f"target {target!r} is among the features")
    return [f for f in features if f not in LEAKAGE_COLUMNS]


def align(df: DataFrame, expected: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the expected columns in order; absent ones are 0, unknown ones go."""
    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else F.lit(0.0).alias(c) for c in expected])


def pad_or_truncate(values: Column, n: int) -> Column:
    """Array of exactly n numbers: zeros added behind, surplus cut off."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(0.0), n)), 1, n)


# The spend model's target and label, never among its features.
SPEND_TARGET_COLUMNS = ("MonetaryTotal", "Churn")
# Columns computed from the spend itself; left out as well by default.
SPEND_DERIVED_COLUMNS = ("AvgBasket", "ValuePerProduct", "SpendingCategory")


def regression_inputs(df: DataFrame, drop_derived: bool = False) -> DataFrame:
    return df.drop(*SPEND_TARGET_COLUMNS, *(SPEND_DERIVED_COLUMNS if drop_derived else ()))
