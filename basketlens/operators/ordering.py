"""Running totals over a global order, spread over range partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.staging import stage


def running_totals(
    df: DataFrame, order: list[Column], totals: dict[str, str], groups: tuple[str, ...] = ()
) -> DataFrame:
    """Add inclusive running sums ``{output: column}`` in the given order, per group.

    Rows must be unique per (group, order key), as after an aggregation. They are
    cut into ordered slices by range and written once, since the slice bounds come
    from a sample; slice totals (one row per slice and group) are summed up and
    added to the sums inside each slice.
    """
    sliced = stage(
        df.repartitionByRange(*[F.col(g) for g in groups], *order).withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    keys = [*groups, "_slice"]
    slice_totals = sliced.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{o}") for o, c in totals.items()])
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_totals.select(*keys, *[F.sum(f"_t_{o}").over(earlier).alias(f"_before_{o}") for o in totals])
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = sliced.withColumns({f"_in_{o}": F.sum(c).over(inside) for o, c in totals.items()}).join(offsets, keys)
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{o}") + F.coalesce(F.col(f"_before_{o}"), F.lit(0))).alias(o) for o in totals],
    )
