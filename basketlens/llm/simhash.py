"""Near-duplicate documents by SimHash fingerprints and BK-trees.

1. A fingerprint has the bits that are set in over half of a text's shingle hashes.
   Equal fingerprints form a class; only its smallest id goes on.
2. Two fingerprints at most ``radius`` bits apart agree on one of ``radius + 1`` runs of
   bits at least. Fingerprints are dealt to a shard for each run's value, so every near
   pair meets in a shard. A shard above ``SHARD`` fingerprints is dealt again by the bits
   that its members may still differ in, so hot shards never reach one task whole.
3. Every shard has a BK-tree: a child is keyed by its Hamming distance to the parent, and
   a search follows the edges within ``radius`` of its own distance. Shards are as many as
   the data needs, so a shard's tree is built where its members meet and no tree of all
   fingerprints is broadcast.
4. A shard reports a spanning forest of its links, not all its pairs. Components by
   alternating large-star and small-star.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketlens.llm.common import pieces, signed
from basketlens.llm.components import connected_components
from basketlens.shipping import map_batches
from basketlens.staging import stage

_U = np.uint64
#: Seed of the shingle hashes.
SEED = 42
BITS = 64
#: Most fingerprints of a shard (8 bytes each); above it the shard is dealt again.
SHARD = 1 << 16
#: Members of a BK-tree's leaf, which are compared without further edges.
LEAF = 32
#: Bytes of a text split at a time.
RUN = 1 << 20

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _runs(text: bytes, width: int) -> Iterator[list[bytes]]:
    """Lists of consecutive words; each repeats the last ``width - 1`` words of the one before."""
    start, kept = 0, []
    while start < len(text):
        found = _BLANK.search(text, start + RUN) if start + RUN < len(text) else None
        stop = found.start() if found else len(text)
        words = kept + text[start:stop].split()
        yield words
        kept, start = words[max(0, len(words) - width + 1) :], stop


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    """The hash of every shingle of consecutive words, space-joined."""
    n = len(words) - width + 1
    if n < 1:
        return np.empty(0, dtype=_U)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, digest = memoryview(b" ".join(words)), xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=_U, count=n)


def fingerprint(text: str | None, width: int) -> int:
    """The bits set in over half of the shingle hashes, repeats included; 0 without words.

    Texts of fewer words than ``width`` have one shingle, their whole word sequence.
    """
    counts, total, words = np.zeros(BITS, dtype=np.int64), 0, []
    for words in _runs((text or "").encode().lower(), width):
        hashes = _hashes(words, width)
        for k in range(0, len(hashes), 1 << 16):
            part = hashes[k : k + (1 << 16)]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if total == 0 and words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    return int(np.packbits(2 * counts > total, bitorder="little").view(_U)[0])


def _fingerprints(width: int):
    def run(batches):
        for piece in pieces(batches, "text"):
            codes = np.fromiter((fingerprint(x.as_py(), width) for x in piece.column(1)), dtype=_U, count=piece.num_rows)
            yield pa.RecordBatch.from_arrays([piece.column(0), signed(codes)], names=["id", "code"])

    return run


class BKTree:
    """Fingerprints by Hamming distance: a node's children are keyed by their distance to it.

    A node is (member, [(distance, child), ...]); what has at most ``LEAF`` members is kept
    as an array of members.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.root = self._grow(np.arange(len(codes)))

    def _grow(self, members: np.ndarray):
        top = [None]
        todo = [(members, top, 0)]
        while todo:
            members, at, place = todo.pop()
            if len(members) <= LEAF:
                at[place] = members
                continue
            rest = members[1:]
            away = np.bitwise_count(self.codes[rest] ^ self.codes[members[0]])
            order = np.argsort(away, kind="stable")
            rest, away = rest[order], away[order]
            cuts = np.flatnonzero(np.diff(away)) + 1
            keys, children = away[np.concatenate([[0], cuts])].tolist(), np.split(rest, cuts)
            below = [None] * len(keys)
            at[place] = (int(members[0]), keys, below)
            todo += [(child, below, k) for k, child in enumerate(children)]
        return top[0]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(member, places of the queries within ``radius`` of it), for every member that has some."""
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, asked = todo.pop()
            if isinstance(node, np.ndarray):
                near = np.bitwise_count(self.codes[node][:, None] ^ queries[asked][None, :]) <= radius
                for k in np.flatnonzero(near.any(axis=1)):
                    yield int(node[k]), asked[near[k]]
                continue
            member, keys, below = node
            away = np.bitwise_count(queries[asked] ^ self.codes[member]).astype(np.int64)
            if (near := away <= radius).any():
                yield member, asked[near]
            for key, child in zip(keys, below, strict=True):
                follow = asked[np.abs(away - key) <= radius]
                if len(follow):
                    todo.append((child, follow))


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    found = parent[nodes]
    while True:
        above = parent[found]
        if (above == found).all():
            parent[nodes] = found
            return found
        found = above


def spanning(codes: np.ndarray, radius: int) -> np.ndarray:
    """For every code the place of one that it is linked to, directly or over others; the same within a component."""
    parent = np.arange(len(codes))
    for member, near in BKTree(codes).search(codes, radius):
        if len(near) > 1:
            roots = np.unique(_roots(parent, np.append(near, member)))
            parent[roots] = roots[0]
    return _roots(parent, np.arange(len(codes)))


def _shard_links(radius: int):
    """Links of every shard; the rows come sorted by shard."""

    def links(codes, reps):
        codes, reps = np.concatenate(codes), np.concatenate(reps)
        if len(codes) < 2:
            return
        root = spanning(codes.view(_U), radius)
        linked = np.flatnonzero(reps[root] != reps)
        if len(linked):
            yield pa.RecordBatch.from_arrays([pa.array(reps[linked]), pa.array(reps[root[linked]])], names=["u", "v"])

    def run(batches):
        shard, codes, reps = None, [], []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            mask, value, code, rep = (batch.column(k).to_numpy() for k in range(4))
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if (mask[a], value[a]) != shard:
                    if codes:
                        yield from links(codes, reps)
                    shard, codes, reps = (mask[a], value[a]), [], []
                codes.append(code[a:b])
                reps.append(rep[a:b])
        if codes:
            yield from links(codes, reps)

    return run


def _masks(mask: int, radius: int) -> list[int]:
    """``mask`` with each of ``radius + 1`` runs of the bits that it leaves open."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * k // (radius + 1) for k in range(radius + 2)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def _long(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def hamming_links(codes: DataFrame, radius: int, shard: int | None = None) -> DataFrame:
    """(u, v) reps of ``codes`` (code, rep) whose codes are at most ``radius`` bits apart.

    ``codes`` is a written table of distinct codes. Of the links within a shard a spanning
    forest is returned: components are those of all links. A shard has at most ``shard``
    codes (``SHARD``).
    """
    most, found, masks = shard or SHARD, [], {0}
    crowded = codes.select(F.lit(0).cast("long").alias("mask"), "code", "rep")
    while masks:
        dealt = F.array()
        for mask in sorted(masks):
            finer = F.array(*[F.lit(_long(x)).cast("long") for x in _masks(mask, radius)])
            dealt = F.when(F.col("mask") == _long(mask), finer).otherwise(dealt)
        shards = crowded.withColumn("mask", F.explode(dealt)).select(
            "mask", F.col("mask").bitwiseAND(F.col("code")).alias("value"), "code", "rep"
        )
        sizes = stage(shards.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1"), "simhash-shards")
        shards = shards.join(sizes, ["mask", "value"])
        small = shards.where(F.col("n") <= most).select("mask", "value", "code", "rep")
        small = small.repartition("mask", "value").sortWithinPartitions("mask", "value")
        found.append(stage(map_batches(small, _shard_links(radius), "u long, v long"), "simhash-links"))
        # At most (radius + 1) ** rounds masks, whatever the number of codes.
        masks = {r["mask"] % (1 << BITS) for r in sizes.where(F.col("n") > most).select("mask").distinct().collect()}
        if masks:
            crowded = stage(shards.where(F.col("n") > most).select("mask", "code", "rep").distinct(), "simhash-crowded")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def simhash_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    radius: int = 3,
    shard: int | None = None,
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    The fingerprint is 16 lower-case hex digits; ``component_id`` is the smallest id reachable
    over links between fingerprints at most ``radius`` bits apart, the row's own included.
    Words are split at ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z. Null, empty and blank texts
    have fingerprint zero, which is linked like any other; texts with fewer words than ``words``
    are one shingle. Rows sharing an id are one document: their links are united and each row
    keeps its own fingerprint. Rows without an id are returned unlinked, component_id null.
    Other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    coded = stage(map_batches(source, _fingerprints(words), "id long, code long"), "simhash-codes")
    known = coded.where("id is not null")
    # Written tables stand on the other side of joins with a hot code: Spark then splits it.
    classes = stage(known.groupBy("code").agg(F.min("id").alias("rep")), "simhash-classes")
    several = known.groupBy("id").agg(F.min("code").alias("low"), F.max("code").alias("high")).where("low < high").select("id")
    tied = known.join(several, "id").join(classes, "code").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    links = hamming_links(classes, radius, shard).union(tied)
    parts = connected_components(links).withColumnRenamed("node", "rep")
    named = classes.join(parts, "rep", "left").select("code", F.coalesce("component", "rep").alias("component"))
    return coded.join(stage(named, "simhash-parts"), "code", "left").select(
        "id",
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"),
    )
