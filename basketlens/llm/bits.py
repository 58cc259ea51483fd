"""Bit tables filled by all partitions.

A table has ``2 ** bits`` places, so what reaches the driver and is broadcast is bounded by
that parameter. More keys make false positives likelier: callers that drop them later only
pay for them, others choose ``bits`` from the number of keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketlens.llm.common import mix
from basketlens.shipping import map_batches

_U = np.uint64


def places(keys: np.ndarray, bits: int, probes: int) -> list[np.ndarray]:
    """``probes`` places of every key, by double hashing."""
    with np.errstate(over="ignore"):
        mixed = mix(keys)
        step = mix(mixed) | _U(1)
        return [((mixed + step * _U(k)) >> _U(64 - bits)).astype(np.int64) for k in range(probes)]


def fill(keys: DataFrame, bits: int, probes: int, words: int, kind: type = _U) -> np.ndarray:
    """(2 ** bits, words) masks of ``kind`` from ``keys`` (key long, number int): bit ``number`` at each place of the key."""

    def run(batches):
        for batch in batches:
            key = batch.column(0).to_numpy().view(_U)
            number = batch.column(1).to_numpy().astype(np.int64)
            for place in places(key, bits, probes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), pa.array(number // 64), pa.array((_U(1) << (number % 64).astype(_U)).view(np.int64))],
                    names=["place", "word", "mask"],
                )

    marked = map_batches(keys.select("key", "number"), run, "place long, word long, mask long")
    rows = marked.groupBy("place", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros((1 << bits, words), dtype=kind)
    table[rows.column("place").to_numpy(), rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(_U)
    return table
