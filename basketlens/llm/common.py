"""Word, shingle and batch helpers shared by the corpus operators.

Words are maximal runs of characters other than ``[\\x20\\x09-\\x0D]`` after lower-casing
A-Z only. Hashing is per distinct word of a batch, everything after that is array work.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: [\x20\x09-\x0D], as characters.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII text takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


def encoded(words: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every word; no nulls. Cut from one buffer, as converting them one by one costs more than hashing them."""
    if not len(words):
        return []
    _, offsets, data = words.buffers()
    kind = np.int64 if pa.types.is_large_string(words.type) else np.int32
    ends = np.frombuffer(offsets, dtype=kind)[words.offset : words.offset + len(words) + 1].tolist()
    whole = data.to_pybytes() if data is not None else b""
    return [whole[a:b] for a, b in pairwise(ends)]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text); nulls have no words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    flat = flat.filter(real).dictionary_encode()
    counts = np.bincount(parent.filter(real).to_numpy(), minlength=len(texts))
    distinct = encoded(flat.dictionary)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct), dtype=_U, count=len(distinct))
    return hashes[flat.indices.to_numpy()], counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle in text order, shingles per text).

    A text with fewer words than ``width`` has one shingle, its whole word sequence;
    a text without words has none.
    """
    factors = odd_numbers(width, 77)
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    per_text = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    out = np.empty(int(per_text.sum()), dtype=_U)
    first = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    with np.errstate(over="ignore"):
        whole = counts >= width
        if whole.any():
            n = len(words) - width + 1
            rolled = np.zeros(n, dtype=_U)
            for k in range(width):
                rolled += words[k : k + n] * factors[k]
            rolled = mix(rolled)
            reps = per_text[whole]
            offset = np.arange(int(reps.sum())) - np.repeat(np.concatenate([[0], np.cumsum(reps)])[:-1], reps)
            out[np.repeat(first[whole], reps) + offset] = rolled[np.repeat(starts[whole], reps) + offset]
        for length in range(1, width):
            short = np.flatnonzero(counts == length)
            if len(short):
                value = np.full(len(short), length, dtype=_U)
                for k in range(length):
                    value += words[starts[short] + k] * factors[k]
                out[first[short]] = mix(value)
    return out, per_text


def distinct_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words, counts = word_hashes(texts)
    hashes, per_text = shingle_hashes(words, counts, width)
    ends = np.cumsum(per_text)
    sets = []
    for stop, n in zip(ends.tolist(), per_text.tolist(), strict=True):
        own = np.sort(hashes[stop - n : stop])
        if n > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        sets.append(own)
    return sets


#: Ids up to this number (16 MB as longs) are broadcast, more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def rows_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``id`` is in ``ids``, a written table of distinct ids."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def without_rows(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids`` (id), a written table of distinct ids; null equals null."""
    gone = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("g.id")), "left_anti")


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
