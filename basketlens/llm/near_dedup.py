"""Near-duplicate documents: universal-hash minima, banding, exact confirmation, components.

1. Rows with the same shingle set form a class; only its smallest id goes on, so exact
   copies, however many, cost one aggregation row.
2. Minima of ``hashes`` universal functions are cut into bands. Within a band bucket every
   member is first compared with the bucket's smallest id only (a star, linear in the rows).
3. Signature agreement rules out pairs five standard deviations below the threshold; the
   others are confirmed on their full shingle sets.
4. Components by alternating large-star and small-star. Members of a bucket that are still
   in different components are compared block by block on signatures inside the tasks, and
   what passes is confirmed on full sets, so no link between different sets is lost to the
   star. Members are dealt to blocks by component: two blocks of one component are never
   compared.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketlens.llm.common import distinct_sets, mix, odd_numbers, pieces, rows_of, signed
from basketlens.llm.components import connected_components
from basketlens.shipping import map_batches
from basketlens.staging import stage

_U = np.uint64
#: Members of a bucket compared at a time; bounds the memory of a task.
BLOCK = 512
#: Places of the signatures for that comparison, and how many of them are looked at first.
LONG, FEW = 1024, 128


def _minima(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """(text, function) minima; all ones for an empty set."""
    a, b = odd_numbers(hashes, 1), odd_numbers(hashes, 2)
    out = np.full((len(sets), hashes), 0xFFFFFFFF, dtype=np.uint32)
    group, size = [], 0

    def flush() -> None:
        x = np.concatenate([sets[i] for i in group]) >> _U(32)
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in group])])[:-1]
        rows = np.array(group)
        for k in range(hashes):
            out[rows, k] = np.minimum.reduceat((x * a[k] + b[k]) >> _U(32), starts)

    with np.errstate(over="ignore"):
        for i, own in enumerate(sets):
            if len(own) == 0:
                continue
            group.append(i)
            size += len(own)
            if size >= 1 << 15:
                flush()
                group, size = [], 0
        if group:
            flush()
    return out


def _sign(words: int, hashes: int, bands: int):
    rows_of = hashes // bands
    factors = odd_numbers(rows_of, 3)
    seeds = odd_numbers(bands, 4)

    def run(batches):
        for piece in pieces(batches, "text"):
            sets = distinct_sets(piece.column(1), words)
            n = len(sets)
            minima = _minima(sets, hashes)
            with np.errstate(over="ignore"):
                keyed = np.zeros((n, bands), dtype=_U)
                cut = minima.astype(_U).reshape(n, bands, rows_of)
                for k in range(rows_of):
                    keyed += cut[:, :, k] * factors[k]
                buckets = mix(mix(keyed) + seeds)
                full = np.array([len(s) > 0 for s in sets])
                high = np.array([mix(s).sum(dtype=_U) if len(s) else 0 for s in sets], dtype=_U)
                low = np.array([mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) if len(s) else 0 for s in sets], dtype=_U)
            short = (minima & 0xFF).astype(np.uint8)
            offsets = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    signed(high),
                    signed(low),
                    pa.array([short[i].tobytes() if full[i] else None for i in range(n)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), signed(buckets[full].reshape(-1))),
                ],
                names=["id", "n_shingles", "high", "low", "signature", "buckets"],
            )

    return run


def _sets(words: int):
    def run(batches):
        for piece in pieces(batches, "text"):
            sets = distinct_sets(piece.column(1), words)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "members"]
            )

    return run


def _confirm(percent: int):
    """Keep pairs (u, v) whose full sets reach the threshold."""

    def run(batches):
        for piece in pieces(batches, "a"):
            u, v, a, b = (piece.column(k) for k in range(4))
            keep = []
            for x, y in zip(a, b, strict=True):
                left, right = (np.frombuffer(s.as_buffer(), dtype=_U) for s in (x, y))
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(mask), v.filter(mask)], names=["u", "v"])

    return run


def _agreeing(least: int):
    """Keep pairs whose signatures agree in at least ``least`` places."""

    def run(batches):
        for piece in pieces(batches, "a"):
            u, v, a, b = (piece.column(k) for k in range(4))
            left = np.frombuffer(b"".join(a.to_pylist()), dtype=np.uint8).reshape(len(a), -1)
            right = np.frombuffer(b"".join(b.to_pylist()), dtype=np.uint8).reshape(len(b), -1)
            mask = pa.array((left == right).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([u.filter(mask), v.filter(mask)], names=["u", "v"])

    return run


def _lengthen(hashes: int):
    """Longer signatures for the few documents that are compared block by block."""

    def run(batches):
        for piece in pieces(batches, "members"):
            sets = [np.frombuffer(x.as_buffer(), dtype=_U) for x in piece.column(1)]
            short = (_minima(sets, hashes) & 0xFF).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([x.tobytes() for x in short], pa.binary())], names=["id", "signature"]
            )

    return run


def _cross(percent: int, hashes: int):
    """Pairs of two blocks that lie in different components and whose signatures agree.

    A pair that shares several buckets is reported in the first of them only.
    """
    few = min(FEW, hashes)
    least_few, least = _least(percent, few), _least(percent, hashes)

    def side(ids, comps, sigs, buckets):
        wide = np.frombuffer(b"".join(sigs), dtype=np.uint8).reshape(len(ids), -1)
        return np.array(ids), np.array(comps), wide, np.array(buckets)

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                ids, comps, sigs, buckets = side(row["ids"], row["comps"], row["sigs"], row["buckets"])
                ids2, comps2, sigs2, buckets2 = side(row["ids2"], row["comps2"], row["sigs2"], row["buckets2"])
                u, v = [], []
                for i in range(len(ids)):
                    other = comps2 != comps[i]
                    if row["same"]:
                        other[: i + 1] = False
                    near = np.flatnonzero(other)
                    near = near[(sigs2[near, :few] == sigs[i, :few]).sum(axis=1) >= least_few]
                    near = near[(sigs2[near] == sigs[i]).sum(axis=1) >= least]
                    first = (buckets2[near] == buckets[i]).argmax(axis=1)
                    near = near[buckets[i][first] == row["bucket"]]
                    u += [int(ids[i])] * len(near)
                    v += ids2[near].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _least(percent: int, hashes: int) -> int:
    """Agreeing places that a pair at the threshold reaches but for five standard deviations."""
    share = percent / 100
    return max(0, int((share - 5 * sqrt(share * (1 - share) / hashes)) * hashes))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    hashes: int = 160,
    bands: int = 32,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Two rows are linked when 100 * intersection >= percent * union of their distinct
    ``words``-word shingles; component_id is the smallest id reachable over links. With
    160 functions in 32 bands a pair at exactly 0.8 is missed with probability 3e-6.
    Texts with fewer words count as one shingle, null and empty texts have none and are
    linked with nothing. Rows sharing an id are one document: their links are united and
    each row is returned with its own n_shingles. Rows without an id are returned
    unlinked: component_id null, kept true. Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed_rows = stage(
        map_batches(
            source,
            _sign(words, hashes, bands),
            "id long, n_shingles long, high long, low long, signature binary, buckets array<long>",
        ),
        "near-signatures",
    )
    linkable = signed_rows.where("id is not null and n_shingles > 0")
    # Written tables stand on the other side of every join with a hot key: Spark then splits it.
    classes = stage(linkable.groupBy("high", "low").agg(F.min("id").alias("rep")), "near-classes")

    # One row per class: the class's smallest id with its buckets and signature.
    reps = (
        linkable.join(classes.withColumnRenamed("rep", "id"), ["high", "low", "id"])
        .dropDuplicates(["high", "low", "id"])
        .select("id", "signature", "buckets")
    )
    banded = stage(reps.select("id", F.explode("buckets").alias("bucket")), "near-bands")
    shared = (
        banded.groupBy("bucket")
        .agg(F.min("id").alias("centre"), F.max("id").alias("last"))
        .where("centre < last")
        .select("bucket", "centre")
    )
    members = stage(banded.join(stage(shared, "near-shared"), "bucket"), "near-members")
    candidates = stage(members.select("id").distinct(), "near-ids")
    signatures = stage(
        linkable.join(classes.select(F.col("rep").alias("id"), "high", "low"), ["id", "high", "low"])
        .dropDuplicates(["id", "high", "low"])
        .select("id", "signature", "buckets")
        .join(candidates, "id", "left_semi"),
        "near-candidates",
    )
    sets = stage(
        map_batches(rows_of(source.where("id is not null"), candidates), _sets(words), "id long, members binary"),
        "near-sets",
    )

    least = _least(percent, hashes)

    def attach(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
        left = values.select(F.col("id").alias("u"), F.col(column).alias("a"))
        right = values.select(F.col("id").alias("v"), F.col(column).alias("b"))
        return pairs.join(right, "v").join(left, "u").select("u", "v", "a", "b")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        return stage(map_batches(attach(pairs, sets, "members"), _confirm(percent), "u long, v long"), name)

    stars = members.where("id <> centre").select(F.col("centre").alias("u"), F.col("id").alias("v")).distinct()
    stars = map_batches(attach(stars, signatures, "signature"), _agreeing(least), "u long, v long")
    links = confirmed(stars, "near-links")
    # Rows of one document id with different texts tie their classes together.
    named = linkable.select("id", "high", "low").join(classes, ["high", "low"]).select("id", "rep")
    several = named.groupBy("id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    tied = named.where("id <> rep").join(several.select("id"), "id", "left_semi").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    links = links.union(tied)
    parts = stage(connected_components(links), "near-parts")

    # Buckets whose members are not all in one component.
    labelled = members.join(parts.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    labelled = stage(labelled.join(stage(mixed, "near-buckets"), "bucket", "left_semi"), "near-mixed")
    again = labelled.select("id").distinct()
    longer = map_batches(sets.join(again, "id", "left_semi"), _lengthen(LONG), "id long, signature binary")
    longer = stage(longer.join(signatures.select("id", "buckets"), "id"), "near-long")
    rest = _residual_pairs(labelled, longer, percent)
    more = confirmed(rest, "near-links")
    parts = connected_components(parts.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))

    class_parts = classes.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "high", "low", F.coalesce("component", "rep").alias("component")
    )
    return signed_rows.join(class_parts, ["high", "low"], "left").select(
        "id",
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))).alias(
            "component_id"
        ),
        F.when((F.col("id").isNull()) | (F.col("n_shingles") == 0), F.lit(True))
        .otherwise(F.col("id") == F.col("component"))
        .alias("kept"),
    )


def _residual_pairs(labelled: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """(u, v) of one bucket and different components whose signatures agree.

    Members are dealt to blocks by hashes and counts, so a block holds about BLOCK / 2
    members whatever the size of the bucket.
    """
    sizes = labelled.groupBy("bucket").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / (BLOCK // 2)).cast("long")
    by_component = labelled.groupBy("bucket", "component").agg(F.count("*").alias("m"))
    cut = by_component.join(sizes, "bucket").select(
        "bucket", "component", "m", blocks.alias("blocks"), F.ceil(F.col("m") / (BLOCK // 2)).cast("long").alias("own")
    )
    placed = (
        labelled.join(cut, ["bucket", "component"])
        .join(signatures, "id")
        .select(
            "bucket",
            "id",
            "component",
            "signature",
            "buckets",
            # Small components share blocks, a large one has its own.
            F.when(F.col("own") == 1, F.xxhash64(F.pmod(F.xxhash64("component"), F.col("blocks"))))
            .otherwise(F.xxhash64("component", F.pmod(F.xxhash64("id"), F.col("own"))))
            .alias("block"),
        )
        .groupBy("bucket", "block")
        .agg(
            F.collect_list("id").alias("ids"),
            F.collect_list("component").alias("comps"),
            F.collect_list("signature").alias("sigs"),
            F.collect_list("buckets").alias("buckets"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
    )
    placed = stage(placed, "near-blocks")
    other = placed.select("bucket", *[F.col(c).alias(f"{c}2") for c in ("block", "ids", "comps", "sigs", "buckets", "low", "high")])
    pure = (F.col("low") == F.col("high")) & (F.col("low2") == F.col("high2")) & (F.col("low") == F.col("low2"))
    pairs = (
        placed.join(other, "bucket")
        .where((F.col("block") <= F.col("block2")) & ~pure)
        .select("bucket", "ids", "comps", "sigs", "buckets", "ids2", "comps2", "sigs2", "buckets2", (F.col("block") == F.col("block2")).alias("same"))
    )
    pairs = map_batches(pairs, _cross(percent, LONG), "u long, v long")
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
