"""Exact duplicates through counting quotient filters and byte verification.

1. Each row gets a 64-bit fingerprint of its normalised text (A-Z lower-cased).
2. Every partition counts its fingerprints in a counting quotient filter: the high bits
   (quotient) address a run, the low bits (remainders) are stored sorted with counts. The
   filter is cut into segments of quotients; segments of all partitions meet in one task
   and merge without loss by walking the sorted remainders. A text with a third of all
   rows is one entry per partition.
3. Rows whose fingerprint counts more than one are verified byte by byte: they are grouped
   by the normalised text itself, combined before the shuffle. Colliding fingerprints fall
   apart there.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketlens.llm.common import pieces
from basketlens.shipping import map_batches, ship
from basketlens.staging import stage

_U = np.uint64
#: Quotient bits inside a segment.
QUOTIENT_BITS = 16
#: Entries a partition's filter may hold before it is emitted and a new one begun.
FILTER_ENTRIES = 1 << 20


@dataclass
class CountingQuotientFilter:
    """Occupied quotients with run lengths; remainders sorted within a run, with counts."""

    remainder_bits: int
    quotients: np.ndarray
    lengths: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, fingerprints: np.ndarray, remainder_bits: int, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        """Count ``fingerprints`` (unsigned, any order, repeats allowed)."""
        order = np.argsort(fingerprints, kind="stable")
        ranked = fingerprints[order]
        weights = np.ones(len(ranked), dtype=np.int64) if counts is None else counts[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.array([], dtype=np.int64)
        entries = ranked[first]
        totals = np.add.reduceat(weights, first) if len(first) else np.array([], dtype=np.int64)
        quotients, lengths = np.unique(entries >> _U(remainder_bits), return_counts=True)
        return cls(remainder_bits, quotients, lengths.astype(np.int64), entries & _U((1 << remainder_bits) - 1), totals)

    def fingerprints(self) -> np.ndarray:
        return (np.repeat(self.quotients, self.lengths) << _U(self.remainder_bits)) | self.remainders

    def merge(self, *others: CountingQuotientFilter) -> CountingQuotientFilter:
        """One filter with the counts of all; nothing is lost, as remainders are kept whole."""
        all_of = (self, *others)
        return self.of(
            np.concatenate([f.fingerprints() for f in all_of]), self.remainder_bits, np.concatenate([f.counts for f in all_of])
        )

    def segments(self, segment_bits: int):
        """(segment number, filter) for each range of quotients that holds entries."""
        entries = self.fingerprints()
        parts = (entries >> _U(64 - segment_bits)).astype(np.int64) if segment_bits else np.zeros(len(entries), dtype=np.int64)
        edges = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1], [True]])) if len(parts) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(parts[a]), self.of(entries[a:b], self.remainder_bits, self.counts[a:b])

    def to_bytes(self) -> list[bytes]:
        return [x.tobytes() for x in (self.quotients, self.lengths, self.remainders, self.counts)]

    @classmethod
    def from_bytes(cls, remainder_bits: int, quotients: bytes, lengths: bytes, remainders: bytes, counts: bytes) -> CountingQuotientFilter:
        return cls(
            remainder_bits,
            np.frombuffer(quotients, _U),
            np.frombuffer(lengths, np.int64),
            np.frombuffer(remainders, _U),
            np.frombuffer(counts, np.int64),
        )


def _normalised(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.binary())


def _prints(values: list[bytes], bits: int) -> np.ndarray:
    found = np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values), dtype=_U, count=len(values))
    return found << _U(64 - bits)


def _fingerprint(bits: int):
    def run(batches):
        for piece in pieces(batches, "text"):
            values = _normalised(piece.column(1)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array(_prints(values, bits).view(np.int64)),
                    pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string()),
                ],
                names=["id", "print", "sha256"],
            )

    return run


def _texts(bits: int):
    def run(batches):
        for piece in pieces(batches, "text"):
            binary = _normalised(piece.column(1))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(_prints(binary.to_pylist(), bits).view(np.int64)), binary], names=["id", "print", "bytes"]
            )

    return run


SEGMENT = "segment long, quotients binary, lengths binary, remainders binary, counts binary"


def _count(segment_bits: int, remainder_bits: int):
    def emit(counted: CountingQuotientFilter):
        rows = [(n, *part.to_bytes()) for n, part in counted.segments(segment_bits)]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            names=["segment", "quotients", "lengths", "remainders", "counts"],
        )

    def run(batches):
        counted = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            own = CountingQuotientFilter.of(batch.column(0).to_numpy().view(_U), remainder_bits)
            counted = own if counted is None else counted.merge(own)
            if len(counted.remainders) >= FILTER_ENTRIES:
                yield emit(counted)
                counted = None
        if counted is not None:
            yield emit(counted)

    return run


def _merge(remainder_bits: int):
    def run(rows: pa.Table) -> pa.Table:
        parts = [
            CountingQuotientFilter.from_bytes(remainder_bits, *(r[k] for k in ("quotients", "lengths", "remainders", "counts")))
            for r in rows.to_pylist()
        ]
        merged = parts[0].merge(*parts[1:])
        often = merged.counts > 1
        return pa.table(
            {"print": merged.fingerprints()[often].view(np.int64), "n": merged.counts[often]},
            schema=pa.schema([("print", pa.int64()), ("n", pa.int64())]),
        )

    return run


def repeated_fingerprints(prints: DataFrame, per_segment: int = 1 << 18) -> DataFrame:
    """(print, n) of fingerprints that occur more than once in ``prints`` (print long)."""
    rows = prints.count()
    segment_bits = max(6, int(np.ceil(np.log2(max(1, rows / per_segment)))))
    remainder_bits = 64 - segment_bits - QUOTIENT_BITS
    cut = map_batches(prints.select("print"), _count(segment_bits, remainder_bits), SEGMENT)
    return cut.groupBy("segment").applyInArrow(_merge(remainder_bits), "print long, n long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprint_bits: int = 64) -> DataFrame:
    """(id, keep_id, group_size, kept, sha256) for every row of ``docs``.

    Rows are equal when their texts are identical after lower-casing A-Z; null counts as
    empty. keep_id is the largest id among equal rows, ``kept`` marks rows with that id
    (rows that share the id and the text are all marked). Missing ids are smaller than
    any other; a group without ids has keep_id null and keeps its rows. ``sha256`` names
    the class after byte verification. Other columns are ignored, an empty table gives
    an empty result. Smaller ``fingerprint_bits`` only make more rows be verified.
    """
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = stage(map_batches(source, _fingerprint(fingerprint_bits), "id long, print long, sha256 string"), "exact-prints")
    repeated = stage(repeated_fingerprints(prints), "exact-repeated").select("print")
    suspects = map_batches(source, _texts(fingerprint_bits), "id long, print long, bytes binary").join(repeated, "print", "left_semi")
    classes = (
        suspects.groupBy("print", "bytes")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("print", F.sha2("bytes", 256).alias("sha256"), "keep_id", "group_size")
    )
    classes = stage(classes, "exact-classes").select(
        "print", "sha256", "keep_id", "group_size", F.lit(True).alias("verified")
    )
    return prints.join(classes, ["print", "sha256"], "left").select(
        "id",
        F.when(F.col("verified"), F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(F.col("verified"), F.col("id").eqNullSafe(F.col("keep_id"))).otherwise(F.lit(True)).alias("kept"),
        "sha256",
    )
