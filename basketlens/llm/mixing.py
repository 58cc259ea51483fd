"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets share a budget of words by weight and stop at a multiple of a source's size; the
excess is shared again by weight (water filling, in closed form over the source table).
The budget is then handed out in blocks of equal tokens: the block goes to the source with
the highest quotient target / (2 * blocks + 1). Within a source the blocks are apportioned
in the same way to shards of bounded size by their words, which gives an integer quota per
shard. A shard lays its documents out in seeded order, and its blocks are taken as whole
passes and one arc of consecutive blocks from a seeded start, so every choice is a closed
form of a document's position and no block row is ever made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.staging import stage


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _hash(seed: int, *parts: Column) -> Column:
    """The first 32 bits of an MD5 of the seed and the parts, as a long."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int], share_pct: int, most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    The windows here run over the source table, one row per source, after the documents
    have been aggregated.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    weighed = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    # Sources fill up in the order of limit / weight; those before the water line stop at their limit.
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(Window.partitionBy()) * (share_pct / 100)
    level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = weighed.withColumn("level", level)
    line = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct(F.col("limit") / F.col("weight"), "level"))).over(
        Window.partitionBy()
    )["level"]
    return levels.withColumn("line", line).select(
        "source", "source_size", F.least("limit", F.coalesce(F.col("line") * F.col("weight"), F.col("limit"))).alias("target")
    )


def sainte_lague(votes: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """(*within, *keys, quota): ``blocks`` of each group handed out by highest quotients of ``votes``.

    ``votes`` has the keys, ``votes`` (double) and ``blocks`` (long, the same in a group).
    With S keys in a group, a divisor of votes / (blocks - S / 2) seats all but at most S
    blocks at once; only the quotients of the few that remain are listed and ranked.
    """
    group = Window.partitionBy(*within)
    total, size = F.sum("votes").over(group), F.count("*").over(group)
    start = F.greatest(F.col("blocks") - F.ceil(F.col("size") / 2), F.lit(0))
    seated = votes.where("votes > 0").withColumns({"total": total, "size": size})
    seated = seated.withColumn(
        "base", F.greatest(F.round(F.col("votes") * start / F.col("total")).cast("long") - 1, F.lit(0).cast("long"))
    )
    seated = seated.withColumn("open", F.col("blocks") - F.sum("base").over(group))
    # Up to the divisor of blocks + S / 2, no key can be given more than this.
    more = F.ceil(F.col("votes") * (F.col("blocks") + F.col("size")) / F.col("total")).cast("long") + 1 - F.col("base")
    listed = seated.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(more, F.lit(1).cast("long")))))
    quotient = F.col("votes") / (2 * (F.col("base") + F.col("k")) + 1)
    ranked = Window.partitionBy(*within).orderBy(quotient.desc(), *[F.col(c).asc_nulls_last() for c in keys])
    return (
        listed.withColumn("place", F.row_number().over(ranked))
        .groupBy(*within, *keys, "base")
        .agg(F.count(F.when(F.col("place") <= F.col("open"), 1)).alias("won"))
        .select(*within, *keys, (F.col("base") + F.col("won")).alias("quota"))
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share_pct: int = 150,
    most: int = 2,
    block_words: int = 32,
    shard_words: int = 1 << 22,
    seed: int = 20,
) -> DataFrame:
    """(id, source, size, source_size, target, taken) for every row of ``docs``.

    size counts the words of the whole text (null: 0). Sources by code point, null last and
    a source of its own, take the weights in turn. ``taken`` is the number of words the mix
    takes of the row, repeats counted: never more than ``most`` times its size, and together
    within a block per shard of the source's target. Rows that agree in id, source and size
    are interchangeable, so the result depends on neither order nor partitioning. Rows
    without words are returned with taken 0; a table without words has targets 0. An empty
    table gives an empty result.
    """
    sized = stage(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")
        ),
        "mix-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(sources.select("source", "source_size"), weights, share_pct, most)
    shards = F.greatest(F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("rows") / (shard_words / 16)), F.lit(1))
    plan = stage(
        targets.join(sources.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("shards", shards.cast("long"))
        .drop("rows"),
        "mix-targets",
    )
    blocks = plan.withColumn("blocks", F.floor(F.sum("target").over(Window.partitionBy()) / block_words + 0.5).cast("long"))
    quotas = sainte_lague(blocks.select("source", F.col("target").alias("votes"), "blocks"), ["source"])

    plan_of = plan.withColumnRenamed("source", "s")
    placed = sized.join(plan_of, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = stage(
        placed.withColumn("shard", F.pmod(_hash(seed, F.col("id")), F.col("shards"))).withColumn(
            "draw", F.md5(F.concat_ws(":", F.lit(str(seed + 1)), F.coalesce(F.col("id").cast("string"), F.lit("-"))))
        ),
        "mix-placed",
    )
    shard_sizes = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    seats = shard_sizes.join(quotas.select(F.col("source").alias("s"), F.col("quota").alias("blocks")), F.col("source").eqNullSafe(F.col("s")))
    per_shard = sainte_lague(
        seats.select("source", "shard", F.col("shard_size").cast("double").alias("votes"), "blocks"), ["shard"], ["source"]
    )
    wanted = (
        shard_sizes.alias("z")
        .join(
            per_shard.alias("q"),
            F.col("z.source").eqNullSafe(F.col("q.source")) & (F.col("z.shard") == F.col("q.shard")),
            "left",
        )
        .select(
            F.col("z.source").alias("s"),
            F.col("z.shard").alias("h"),
            "shard_size",
            F.ceil(F.col("shard_size") / block_words).cast("long").alias("n"),
            F.coalesce("quota", F.lit(0).cast("long")).alias("quota"),
        )
    )
    laid = Window.partitionBy("source", "shard").orderBy("draw", "id", "size")
    rows = placed.withColumn("stop", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.join(wanted, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))

    zero = F.lit(0).cast("long")
    n, quota = F.col("n"), F.least(F.col("quota"), F.col("n") * most)
    passes = F.when(n > 0, F.floor(quota / n)).otherwise(zero).cast("long")
    rest = quota - passes * n
    first = F.when(n > 0, F.pmod(_hash(seed + 2, F.col("source"), F.col("shard")), n)).otherwise(zero)
    begin, stop = F.col("stop") - F.col("size"), F.col("stop")

    def overlap(a: Column, b: Column) -> Column:
        """Words of this document in blocks [a, b)."""
        return F.greatest(F.least(stop, b * block_words) - F.greatest(begin, a * block_words), zero)

    arc = overlap(first, F.least(first + rest, n)) + overlap(zero, F.greatest(first + rest - n, zero))
    return rows.select("id", "source", "size", "source_size", "target", (passes * F.col("size") + arc).alias("taken"))
