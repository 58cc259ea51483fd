"""Minority oversampling by interpolation towards near neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.functions.hashing import draw, uniform
from basketlens.operators.neighbours import CELL_ROWS, nearest_neighbours
from basketlens.operators.ordering import running_totals
from basketlens.operators.split import smallest_draw_cuts
from basketlens.staging import stage


def smote(
    train: DataFrame,
    features: list[str],
    label: str,
    key: str,
    k: int = 5,
    seed: int = 42,
    cell_rows: int = CELL_ROWS,
    categorical: tuple[str, ...] = (),
    trees: int = 0,
) -> DataFrame:
    """Training rows plus synthetic rows until every class is as large as the largest.

    Output: ``key, copy, label, features``. Real rows have ``copy`` 0; a synthetic
    row has its parent's key and counts from 1. The new rows are dealt evenly over
    the parents (the rest in draw order); the neighbour's rank and the place
    between the two rows are draws of (parent, copy). ``categorical`` columns hold
    codes: they take the code of the nearer of the two rows instead of a value
    between two codes. Keys may be text and may repeat: the synthetic rows of a key's
    later rows count on, so (key, copy) is unique among them. Rows without a class are
    passed through and make no class. ``trees`` makes the neighbour search approximate
    with bounded work per row (see ``nearest_neighbours``).
    """
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).toLocalIterator()}
    known = {value: n for value, n in counts.items() if value is not None}
    largest = max(known.values(), default=0)
    numbers = [F.col(c).cast("double").alias(c) for c in features]
    out = train.select(key, F.lit(0).alias("copy"), label, *numbers)
    for value, rows in sorted(known.items()):
        if rows < largest:
            made = _synthetic(
                train, value, rows, largest - rows, features, label, key, k, seed, cell_rows, categorical, trees
            )
            out = out.unionByName(made)
    return out


def _repeat(df: DataFrame, times: Column, name: str, chunk: int = 10_000) -> DataFrame:
    """Every row ``times`` times with ``name`` from 0; long repeats are dealt over many rows first."""
    parts = F.sequence(F.lit(0), F.floor((times - 1) / chunk).cast("int"))
    dealt = df.withColumn("_part", F.explode(parts)).withColumn("_times", times)
    inside = F.sequence(F.lit(0), F.least(F.col("_times") - F.col("_part") * chunk, F.lit(chunk)).cast("int") - 1)
    return dealt.withColumn("_at", F.explode(inside)).withColumn(name, F.col("_part") * chunk + F.col("_at")).drop("_part", "_times", "_at")


def _synthetic(
    train, value, rows, wanted, features, label, key, k, seed, cell_rows, categorical, trees
) -> DataFrame:
    if rows < 2:
        raise ValueError(f"class {value!r} has a single row: no neighbour to interpolate to")
    k = min(k, rows - 1)
    members = train.where(F.col(label) == F.lit(value)).select(
        F.col(key).alias("key"), F.array(*[F.col(c).cast("double") for c in features]).alias("vec")
    )
    # Rows of one key are numbered by their vectors, so every row has a draw of its own.
    groups = members.groupBy("key", "vec").agg(F.count("*").alias("copies")).withColumn("vid", F.md5(F.col("vec").cast("string")))
    named = F.coalesce(F.col("key").cast("string"), F.lit("-"))
    groups = stage(
        running_totals(groups.withColumn("of", named), [F.col("vid")], {"upto": "copies"}, groups=("of",)), "minority"
    )
    numbered = _repeat(groups.withColumn("before", F.col("upto") - F.col("copies")), F.col("copies"), "offset")
    numbered = numbered.withColumn("index", F.col("before") + F.col("offset")).select("key", "vec", "vid", "index")
    first = draw(f"smote{seed}", F.coalesce(F.col("key").cast("string"), F.lit("-")))
    later = draw(f"smote{seed}", F.coalesce(F.col("key").cast("string"), F.lit("-")), F.col("index"))
    numbered = stage(numbered.withColumn("ticket", F.when(F.col("index") == 0, first).otherwise(later)), "minority")
    each, rest = divmod(wanted, rows)
    cut = smallest_draw_cuts(numbered.select(F.lit("all").alias("stratum"), F.col("ticket").alias("draw")), {"all": (rest, rows)})
    distinct, neighbours = nearest_neighbours(groups.select("key", "vec", "copies"), k, cell_rows, trees=trees)
    copies = numbered.withColumn("copies", F.lit(each) + (F.col("ticket") <= F.lit(cut["all"])).cast("int")).where("copies > 0")
    reps = distinct.select("rep", F.md5(F.col("vec").cast("string")).alias("vid"))
    parents = _repeat(copies, F.col("copies"), "made").join(reps, "vid")
    parents = parents.select(
        "key", "vec", "rep", (F.col("index") * (each + 1) + F.col("made") + 1).cast("int").alias("copy")
    )
    share = uniform(f"rank{seed}", "key", "copy")
    if trees:
        # An approximate search may know fewer than k neighbours of a row, or none: then the row itself serves.
        known = neighbours.groupBy("rep").agg(F.max("rank").alias("known"))
        parents = parents.join(known, "rep", "left").withColumn("rank", (F.floor(share * F.coalesce("known", F.lit(1))) + 1).cast("int"))
        drawn = parents.join(neighbours, ["rep", "rank"], "left").withColumn("neighbour", F.coalesce("neighbour", "vec"))
    else:
        drawn = parents.withColumn("rank", (F.floor(share * k) + 1).cast("int")).join(neighbours, ["rep", "rank"])
    gap = uniform(f"gap{seed}", "key", "copy")
    made = drawn.withColumn("gap", gap)

    def mixed(i: int, column: str):
        own, other = F.col("vec")[i], F.col("neighbour")[i]
        if column in categorical:
            return F.when(F.col("gap") < 0.5, own).otherwise(other)
        return own + F.col("gap") * (other - own)

    return made.select(
        F.col("key").alias(key),
        "copy",
        F.lit(value).alias(label),
        *[mixed(i, c).alias(c) for i, c in enumerate(features)],
    )
