"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

The index is three written tables in the shared folder:

* ``lines``   (high, low, id, refs): how often a document holds a line key, exactly;
* ``keys``    (shard, high, low, docs, first): documents and smallest id per key;
* ``filters`` (shard, filter): a cuckoo filter per shard of keys.

Inserting documents counts the batch's keys with map-side combine, asks each shard's filter
about the distinct keys only and looks up exact counts for those the filter may know; keys
it does not know are new and need no lookup. Deleting documents lowers the counts, takes
keys without documents out of the filters and gives a line back to the next document that
holds it. A line in a third of all documents is one key per task before the shuffle; the
join back to documents is split by Spark where a key is hot.
"""

from __future__ import annotations

import hashlib
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.llm.common import BLANKS, pieces
from basketlens.llm.cuckoo import CuckooFilter
from basketlens.shipping import map_batches, ship
from basketlens.staging import stage

_U = np.uint64
LINES = "id long, high long, low long, refs long"
KEYS = "shard long, high long, low long, docs long, first long"
FILTERS = "shard long, filter binary"


def _keyed(texts: pa.Array, least: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lines, row of each line, whether its key is long enough, key halves)."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    keys = pc.ascii_lower(pc.ascii_trim(lines, characters=BLANKS))
    long_enough = pc.greater_equal(pc.utf8_length(keys), least).to_numpy(zero_copy_only=False)
    distinct = keys.filter(pa.array(long_enough)).dictionary_encode()
    digests = [xxhash.xxh3_128_intdigest(k) for k in distinct.dictionary.to_pylist()]
    at = distinct.indices.to_numpy()
    high = np.zeros(len(lines), dtype=_U)
    low = np.zeros(len(lines), dtype=_U)
    high[long_enough] = np.array([d >> 64 for d in digests], dtype=_U)[at]
    low[long_enough] = np.array([d & 0xFFFFFFFFFFFFFFFF for d in digests], dtype=_U)[at]
    return lines, row, long_enough, high, low


def _extract(least: int):
    def run(batches):
        for piece in pieces(batches, "text"):
            _, row, wanted, high, low = _keyed(piece.column(1), least)
            own = pa.table(
                {
                    "id": piece.column(0).take(pa.array(row[wanted])),
                    "high": high[wanted].view(np.int64),
                    "low": low[wanted].view(np.int64),
                }
            )
            counted = own.group_by(["id", "high", "low"]).aggregate([([], "count_all")])
            yield from counted.rename_columns(["id", "high", "low", "refs"]).cast(
                pa.schema([("id", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("refs", pa.int64())])
            ).to_batches()

    return run


def _rewrite(least: int):
    def run(batches):
        for piece in pieces(batches, "text"):
            lines, row, wanted, high, low = _keyed(piece.column(1), least)
            n = piece.num_rows
            drops = piece.column(2)
            drop = np.zeros(len(lines), dtype=bool)
            n_lines = np.bincount(row, minlength=n)
            ends = np.cumsum(n_lines)
            for i in np.flatnonzero(drops.is_valid().to_numpy(zero_copy_only=False)).tolist():
                gone = np.array([(d["high"], d["low"]) for d in drops[i].as_py()], dtype=np.int64).view(_U)
                a, b = ends[i] - n_lines[i], ends[i]
                known = np.isin(high[a:b], gone[:, 0]) & wanted[a:b]
                pairs = set(map(tuple, gone.tolist()))
                for k in np.flatnonzero(known).tolist():
                    drop[a + k] = (int(high[a + k]), int(low[a + k])) in pairs
            stays = pa.array(~drop)
            counts = np.bincount(row[~drop], minlength=n)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines.filter(stays)), "\n")
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_lines - counts, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts.cast(pa.binary()).to_pylist()], pa.string()),
                    texts,
                    *(piece.column(k) for k in range(3, piece.num_columns)),
                ],
                names=["id", "n_lines", "n_dropped", "kept_sha256", "kept_text", *piece.schema.names[3:]],
            )

    return run


def _probe(keys: pa.Table, old: pa.Table) -> pa.Table:
    """Which of a batch's keys a shard's filter may know."""
    filters = old.column("filter").to_pylist()
    hashes = keys.column("high").to_numpy().view(_U)
    seen = CuckooFilter.from_bytes(filters[0]).contains(hashes) if filters else np.zeros(len(hashes), dtype=bool)
    return keys.append_column("seen", pa.array(seen, pa.bool_()))


def _change(keys_per_shard: int):
    """Add keys to a shard's filter (``added``) or take them out."""

    def run(keys: pa.Table, old: pa.Table) -> pa.Table:
        shard = (keys if keys.num_rows else old).column("shard")[0].as_py()
        filters = old.column("filter").to_pylist()
        known = CuckooFilter.from_bytes(filters[0]) if filters else CuckooFilter.for_keys(keys_per_shard)
        hashes = keys.column("high").to_numpy().view(_U)
        added = keys.column("added").to_numpy(zero_copy_only=False).astype(bool)
        known.delete(hashes[~added])
        known.insert(hashes[added])
        return pa.table(
            {"shard": pa.array([shard], pa.int64()), "filter": pa.array([known.to_bytes()], pa.binary())},
        )

    return run


class LineIndex:
    """Line keys of a growing set of documents; ``insert`` and ``delete`` undo each other.

    A key is a line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased, at
    least ``least`` characters long, named by a 128-bit hash. Documents without an id take
    no part. Inserting an id twice without deleting it in between is an error.
    """

    def __init__(self, spark: SparkSession, least: int = 10, keys_per_shard: int = 100_000, shards: int = 64) -> None:
        ship(spark)
        self.spark, self.least, self.keys_per_shard, self.shards = spark, least, keys_per_shard, shards
        self.lines = spark.createDataFrame([], LINES)
        self.keys = spark.createDataFrame([], "high long, low long, docs long, first long")
        self.filters = spark.createDataFrame([], FILTERS)
        self.size = 0

    def extract(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, high, low, refs): the keys of ``docs``, one row per document and key."""
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        found = map_batches(rows.where("id is not null"), _extract(self.least), LINES)
        return stage(found, "lines-found").groupBy("id", "high", "low").agg(F.sum("refs").alias("refs"))

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.insert_lines(self.extract(docs, id_col, text_col))

    def insert_lines(self, lines: DataFrame) -> None:
        batch = stage(lines.select("id", "high", "low", "refs"), "lines-batch")
        if self.size and batch.join(self.lines.select("id").distinct(), "id", "left_semi").take(1):
            raise ValueError("a document of this batch is already in the index")
        keys = batch.groupBy("high", "low").agg(F.count("*").alias("docs"), F.min("id").alias("first"))
        keys = stage(keys, "lines-batch-keys")
        self.size += keys.count()
        if self.size > self.shards * self.keys_per_shard:
            self.shards = 1 << ceil(np.log2(2 * self.size / self.keys_per_shard))
            self.filters = self._changed(self._sharded(self.keys), None, True)
        probed = stage(
            self._sharded(keys)
            .groupBy("shard")
            .cogroup(self.filters.groupBy("shard"))
            .applyInArrow(_probe, f"{KEYS}, seen boolean"),
            "lines-probed",
        )
        # Exact counts are looked up only for keys a filter may know.
        old = self.keys.select("high", "low", F.col("docs").alias("had"), F.col("first").alias("was"))
        looked = stage(probed.where("seen").join(old, ["high", "low"], "left"), "lines-looked-up")
        fresh = probed.where("not seen").drop("seen").unionByName(looked.where("had is null").select("shard", "high", "low", "docs", "first"))
        merged = looked.where("had is not null").select(
            "high", "low", (F.col("docs") + F.col("had")).alias("docs"), F.least("first", "was").alias("first")
        )
        self.filters = self._changed(fresh, self.filters, True)
        self.keys = stage(
            self.keys.join(merged, ["high", "low"], "left_anti")
            .unionByName(merged)
            .unionByName(fresh.drop("shard")),
            "lines-keys",
        )
        self.lines = self.lines.unionByName(batch)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents out again; their lines pass to the next document that holds them."""
        gone = ids.select(F.col(id_col).cast("long").alias("id")).distinct()
        touched = stage(self.lines.join(gone, "id", "left_semi").select("high", "low").distinct(), "lines-touched")
        rest = stage(self.lines.join(gone, "id", "left_anti"), "lines-rest")
        again = stage(
            rest.join(touched, ["high", "low"], "left_semi")
            .groupBy("high", "low")
            .agg(F.count("*").alias("docs"), F.min("id").alias("first")),
            "lines-again",
        )
        vanished = touched.join(again, ["high", "low"], "left_anti")
        self.filters = self._changed(self._sharded(vanished), self.filters, False)
        self.keys = stage(self.keys.join(touched, ["high", "low"], "left_anti").unionByName(again), "lines-keys")
        self.lines = rest
        self.size = self.keys.count()

    def _sharded(self, keys: DataFrame) -> DataFrame:
        return keys.select(F.pmod("low", F.lit(self.shards)).alias("shard"), *keys.columns)

    def _changed(self, keys: DataFrame, filters: DataFrame | None, added: bool) -> DataFrame:
        old = self.spark.createDataFrame([], FILTERS) if filters is None else filters
        rows = keys.select("shard", "high", F.lit(added).alias("added"))
        changed = rows.groupBy("shard").cogroup(old.groupBy("shard")).applyInArrow(_change(self.keys_per_shard * 2), FILTERS)
        return stage(changed, "lines-filters")

    def drops(self) -> DataFrame:
        """(id, drops): keys a document loses, as it is not the smallest id that holds them."""
        shared = self.keys.where("docs > 1").select("high", "low", "first")
        return (
            self.lines.join(shared, ["high", "low"])
            .where("id <> first")
            .groupBy("id")
            .agg(F.collect_set(F.struct("high", "low")).alias("drops"))
        )

    def rewrite(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, n_lines, n_dropped, kept_sha256, kept_text), then the other columns of ``docs`` as ``other``."""
        rows = docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(text_col).cast("string").alias("text"),
            F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("other"),
        )
        joined = rows.join(self.drops(), "id", "left").select("id", "text", "drops", "other")
        kind = joined.schema["other"].dataType.simpleString()
        return map_batches(
            joined,
            _rewrite(self.least),
            f"id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string, other {kind}",
        )


def deduplicate_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10, increments: int = 2
) -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256, kept_text, other) for every row of ``docs``.

    Texts are split at ``\\n``; null and empty texts are one empty line. Keys of at least
    ``least`` characters in two or more documents lose all their lines except in the
    smallest id that holds them. Rows sharing an id are one document. Rows without an id
    keep all their lines and claim none. ``other`` holds the remaining columns, whatever
    their names. The corpus enters the index in ``increments`` (by hash of the id), as a
    growing corpus would; the result does not depend on it.
    """
    index = LineIndex(docs.sparkSession, least)
    lines = index.extract(docs, id_col, text_col)
    for part in range(increments):
        index.insert_lines(lines.where(F.pmod(F.xxhash64("id"), F.lit(increments)) == part))
    return index.rewrite(docs, id_col, text_col)
