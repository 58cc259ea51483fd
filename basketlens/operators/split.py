"""Exact hash-driven splits.

Membership is ``draw <= cut``, a plain comparison per row. The cut is the k-th
smallest draw of a stratum, found by counting hexadecimal prefixes: each round
joins the table with one row per stratum and keeps one prefix of it, so neither
the rows of a stratum nor the number of strata end up in one place.

A split is made of keys: all rows of a key are on one side, and sizes count
distinct keys. A key with rows of several classes belongs to the smallest of
them. Rows without a class are a class of their own, rows without a key one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.functions.hashing import draw
from basketlens.staging import stage

FETCH_ROWS = 10_000
LITERAL_STRATA = 64  # cuts of this many strata are written into the plan, more are joined
DIGITS = 3
LENGTH = 32
ABOVE_ALL = "~"  # sorts after every hexadecimal digit
BELOW_ALL = ""  # no draw is at or below it


def draw_cuts(df: DataFrame, wanted: DataFrame, fetch_rows: int = FETCH_ROWS) -> DataFrame:
    """(stratum, cut): k-th smallest draw per stratum.

    ``df`` has (stratum, draw), ``wanted`` has (stratum, k, rows); strata meet
    null-safely. Repeated draws count as often as they occur. Prefixes grow until at
    most ``fetch_rows`` rows of a stratum share one; those are ranked.
    """
    state = wanted.select(
        "stratum",
        F.col("k").cast("long").alias("k"),
        F.col("rows").cast("long").alias("n"),
        F.when(F.col("k") <= 0, BELOW_ALL).when(F.col("k") >= F.col("rows"), ABOVE_ALL).alias("cut"),
        F.lit("").alias("prefix"),
    )
    state = stage(state, "cuts")
    cuts = state.where("cut is not null").select("stratum", "cut")
    left = state.where("cut is null").drop("cut")
    width = 0

    def inside() -> DataFrame:
        both = df.alias("d").join(left.alias("s"), F.col("d.stratum").eqNullSafe(F.col("s.stratum")))
        return both.where(F.col("d.draw").startswith(F.col("s.prefix")))

    while width < LENGTH and (left.agg(F.max("n")).first()[0] or 0) > fetch_rows:
        width = min(LENGTH, width + DIGITS)
        prefix = F.substring("d.draw", 1, width).alias("prefix")
        counts = inside().groupBy("s.stratum", "s.k", prefix).agg(F.count("*").alias("n"))
        upto = Window.partitionBy("stratum").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = counts.withColumn("total", F.sum("n").over(upto)).where("total >= k and total - n < k")
        left = stage(reached.select("stratum", (F.col("k") - F.col("total") + F.col("n")).alias("k"), "n", "prefix"), "cuts")
    # Equal draws are one row here, so a group holds at most fetch_rows distinct ones.
    rows = inside().groupBy("s.stratum", "s.k", "d.draw").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("stratum").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("total", F.sum("n").over(upto)).where("total >= k and total - n < k")
    return cuts.unionByName(found.select("stratum", F.col("draw").alias("cut")))


def smallest_draw_cuts(df: DataFrame, wanted: dict, fetch_rows: int = FETCH_ROWS) -> dict:
    """``draw_cuts`` for a few named strata: {stratum: (k, rows)} to {stratum: cut}."""
    kind = df.schema["stratum"].dataType.simpleString()
    rows = df.sparkSession.createDataFrame([(s, k, n) for s, (k, n) in wanted.items()], f"stratum {kind}, k long, rows long")
    return {r["stratum"]: r["cut"] for r in draw_cuts(df, rows, fetch_rows).collect()}


def allocate(counts: DataFrame, fraction: float) -> DataFrame:
    """(stratum, k, rows) from (stratum, rows): ceil(fraction x n) overall, largest remainders first.

    The windows run over one row per stratum.
    """
    total = F.sum("rows").over(Window.partitionBy())
    shared = counts.withColumn("total", total).withColumn("test", F.ceil(F.round(F.lit(fraction) * F.col("total"), 9)))
    exact = shared.withColumn("exact", F.col("test") * F.col("rows") / F.col("total")).withColumn("floor", F.floor("exact"))
    by_remainder = Window.orderBy((F.col("exact") - F.col("floor")).desc(), F.col("stratum").asc_nulls_last())
    placed = exact.withColumn("place", F.row_number().over(by_remainder)).withColumn(
        "left", F.col("test") - F.sum("floor").over(Window.partitionBy())
    )
    return placed.select("stratum", (F.col("floor") + (F.col("place") <= F.col("left")).cast("long")).alias("k"), "rows")


def _split(
    df: DataFrame, stratum: Column, key: str, fraction: float, seed: int, literal_strata: int = LITERAL_STRATA
) -> DataFrame:
    ticket = draw(f"split{seed}", F.coalesce(F.col(key).cast("string"), F.lit("-")))
    rows = df.select(F.col(key).alias("key"), stratum.alias("stratum"), ticket.alias("draw"))
    keys = rows.groupBy("key", "draw").agg(
        F.min("stratum").alias("stratum"),
        (F.count_distinct("stratum") + F.max(F.col("stratum").isNull().cast("int"))).alias("classes"),
    )
    keys = stage(keys, "split-keys")
    counts = keys.groupBy("stratum").agg(F.count("*").alias("rows"))
    cuts = stage(draw_cuts(keys.select("stratum", "draw"), allocate(counts, fraction)), "split-cuts")
    own, extra = stratum, []
    # Keys with rows of several classes go by one of them.
    torn = keys.where("classes > 1").select(F.col("key").alias("_key"), F.col("stratum").alias("_of"), F.lit(True).alias("_torn"))
    if torn.take(1):
        df = df.join(torn, F.col(key).eqNullSafe(F.col("_key")), "left")
        own, extra = F.when(F.col("_torn"), F.col("_of")).otherwise(stratum), ["_key", "_of", "_torn"]
    few = cuts.limit(literal_strata + 1).collect()
    if len(few) <= literal_strata:
        test = F.lit(False)
        for r in few:
            test = test | (own.eqNullSafe(F.lit(r["stratum"])) & (ticket <= F.lit(r["cut"])))
    else:
        cuts = cuts.select(F.col("stratum").alias("_cut_of"), F.col("cut").alias("_cut"))
        df = df.withColumn("_stratum", own).join(cuts, F.col("_stratum").eqNullSafe(F.col("_cut_of")), "left")
        test, extra = ticket <= F.col("_cut"), [*extra, "_stratum", "_cut_of", "_cut"]
    return df.withColumn("split", F.when(test, "test").otherwise("train")).drop(*extra)


def stratified_split(
    df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42, literal_strata: int = LITERAL_STRATA
) -> DataFrame:
    """Add ``split`` = train/test with exact per-class proportions of the keys."""
    return _split(df, F.col(label), key, fraction, seed, literal_strata)


def random_split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` = train/test with an exact overall proportion of the keys."""
    return _split(df, F.lit("all"), key, fraction, seed)
