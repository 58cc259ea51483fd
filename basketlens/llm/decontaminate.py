"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment.

A score is matches less edits. Edits cut the matches of an alignment into at most one run
more than there are edits, so an alignment that scores ``need`` keeps at least ``need - 1``
of the item's ``n - 1`` pairs of neighbouring words, and any ``n - need + 1`` pairs of the
item hold one that it keeps.

1. The pairs of all items fill a bit table of fixed size; one reading of the texts counts
   how many hold each pair. Every item's ``n - need + 1`` rarest pairs are its seeds, those
   in no text first, as they cost nothing.
2. A second reading cuts passages around seeds, as wide to both sides as an alignment of
   the longest item can reach.
3. Passages and items that share a seed are joined. Where a passage holds enough of the
   item's pairs it is aligned word by word, so copies with replaced, inserted or left-out
   words are found and chance pairs are not.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketlens.llm.bits import fill, places
from basketlens.llm.common import mix, odd_numbers, pieces, without_rows
from basketlens.shipping import map_batches
from basketlens.staging import stage

_U = np.uint64
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words of a seed; what an alignment must keep is stated for pairs.
PAIR = 2
#: Pair counts a task keeps before it passes them on.
HELD = 1 << 17
PASSAGES = "id long, passage string, start long, words binary, grams array<long>"
ITEMS = "item_id long, words binary, grams array<long>, seeds int, reach int"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, words per text): lower-cased, ASCII punctuation stripped, empty words left out."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    flat, parent = lists.flatten().dictionary_encode(), pc.list_parent_indices(lists).to_numpy()
    bare = pc.ascii_trim(flat.dictionary, characters=PUNCTUATION).to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in bare), dtype=_U, count=len(bare))
    real = np.array([bool(w) for w in bare], dtype=bool)
    at = flat.indices.to_numpy()
    keep = real[at] if len(bare) else np.zeros(0, dtype=bool)
    return hashes[at[keep]] if len(bare) else np.array([], dtype=_U), np.bincount(parent[keep], minlength=len(texts))


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the n-gram at every position (those over the end are never asked for)."""
    factors = odd_numbers(size, 55)
    n = max(0, len(words) - size + 1)
    rolled = np.zeros(n, dtype=_U)
    with np.errstate(over="ignore"):
        for k in range(size):
            rolled += words[k : k + n] * factors[k]
        return mix(rolled)


def needed(words: int, threshold: float, least_words: int) -> int:
    """The least score of an item of so many words that counts."""
    return max(ceil(threshold * words), min(words, least_words))


def _reach(words: int, need: int) -> int:
    """The most passage words of an alignment that scores ``need``: the item's and what may be put in."""
    return max(0, 2 * words - need)


def _items(size: int, threshold: float, least_words: int):
    def run(batches):
        for piece in pieces(batches, "text"):
            words, counts = _words(piece.column(1))
            stops = np.cumsum(counts)
            own = [words[b - n : b] for b, n in zip(stops.tolist(), counts.tolist(), strict=True)]
            need = [needed(n, threshold, least_words) for n in counts.tolist()]
            seeds = [max(0, n - k + 1) if n >= size else 0 for n, k in zip(counts.tolist(), need, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([w.tobytes() for w in own], pa.binary()),
                    pa.array([_grams(w, PAIR).view(np.int64) for w in own], pa.list_(pa.int64())),
                    pa.array(seeds, pa.int32()),
                    pa.array([_reach(n, k) if s else 0 for n, k, s in zip(counts.tolist(), need, seeds, strict=True)], pa.int32()),
                ],
                names=["item_id", "words", "grams", "seeds", "reach"],
            )

    return run


def _hits(texts: pa.Array, bitmap: np.ndarray, bits: int, probes: int):
    """(words, words per text, pair at every position, text of each, positions that the bit table may hold)."""
    words, counts = _words(texts)
    grams = _grams(words, PAIR)
    owner = np.repeat(np.arange(len(counts)), counts)
    hit = owner[: len(grams)] == owner[PAIR - 1 :][: len(grams)]
    for place in places(grams, bits, probes):
        hit &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return words, counts, grams, owner, np.flatnonzero(hit)


def _frequencies(table, bits: int, probes: int):
    """(gram, docs): how many texts hold each pair of the bit table, combined in the task."""

    def run(batches):
        held, totals = np.array([], dtype=np.int64), np.array([], dtype=np.int64)
        for piece in pieces(batches, "text"):
            _, _, grams, owner, at = _hits(piece.column(1), table.value, bits, probes)
            if len(at) == 0:
                continue
            own, number = np.unique(grams[at].view(np.int64), return_inverse=True)
            once = np.unique(owner[at] * len(own) + number) % len(own)
            counts = np.concatenate([totals, np.bincount(once, minlength=len(own))])
            held, number = np.unique(np.concatenate([held, own]), return_inverse=True)
            totals = np.bincount(number, weights=counts).astype(np.int64)
            if len(held) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(totals)], names=["gram", "docs"])
                held, totals = held[:0], totals[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(totals)], names=["gram", "docs"])

    return run


def _passages(table, bits: int, probes: int, reach: int):
    """Words around pairs that the bit table may hold; ``reach`` words on both sides, overlaps are united."""

    def run(batches):
        for piece in pieces(batches, "text"):
            words, counts, grams, owner, at = _hits(piece.column(1), table.value, bits, probes)
            if len(at) == 0:
                continue
            starts = np.concatenate([[0], np.cumsum(counts)])
            cut = np.concatenate([[True], (np.diff(at) > 2 * reach + PAIR) | (owner[at[1:]] != owner[at[:-1]])])
            edges = np.append(np.flatnonzero(cut), len(at))
            ids = piece.column(0)
            rows = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                text = int(owner[at[a]])
                begin = max(int(starts[text]), int(at[a]) - reach)
                end = min(int(starts[text + 1]), int(at[b - 1]) + PAIR + reach)
                data = words[begin:end].tobytes()
                first = begin - int(starts[text])
                identifier = ids[text].as_py()
                rows.append(
                    {
                        "id": identifier,
                        "passage": xxhash.xxh3_128_hexdigest(f"{identifier}:{first}:".encode() + data),
                        "start": first,
                        "words": data,
                        "grams": np.unique(grams[at[a:b]].view(np.int64)).tolist(),
                    }
                )
                if len(rows) == 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PASSAGES)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_PASSAGES)

    return run


_PASSAGES = pa.schema(
    [("id", pa.int64()), ("passage", pa.string()), ("start", pa.int64()), ("words", pa.binary()), ("grams", pa.list_(pa.int64()))]
)


def smith_waterman(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(best local score, passage position after it): match 1, replacement and gap -1; a row at a time."""
    at = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, 1, -1)
        following = np.zeros_like(row)
        following[1:] = np.maximum(np.maximum(diagonal, row[1:] - 1), 0)
        # A gap of k words costs k: the running maximum of score + position does all lengths at once.
        row = np.maximum.accumulate(following + at) - at
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _places(passage: np.ndarray, item: np.ndarray, need: int) -> list[tuple[int, int]]:
    """Parts of the passage, as wide as an alignment reaches, that hold enough of the item's pairs to score ``need``."""
    at = np.flatnonzero(np.isin(_grams(passage, PAIR), _grams(item, PAIR)))
    reach = _reach(len(item), need)
    parts = np.split(at, np.flatnonzero(np.diff(at) > 2 * reach + PAIR) + 1)
    return [
        (max(0, int(p[0]) - reach), min(len(passage), int(p[-1]) + PAIR + reach)) for p in parts if len(p) >= max(1, need - 1)
    ]


def _align(threshold: float, least_words: int):
    def run(batches):
        for piece in pieces(batches, "words", 1 << 22):
            out = []
            for row in piece.to_pylist():
                whole, item = (np.frombuffer(row[k], dtype=_U) for k in ("words", "item_words"))
                need = needed(len(item), threshold, least_words)
                for first, last in _places(whole, item, need):
                    passage = whole[first:last]
                    score, end = smith_waterman(passage, item)
                    if score >= need:
                        _, back = smith_waterman(passage[:end][::-1], item[::-1])
                        out.append(
                            {
                                "id": row["id"],
                                "item_id": row["item_id"],
                                "score": score / len(item),
                                "start": row["start"] + first + end - back,
                                "end": row["start"] + first + end,
                            }
                        )
            yield pa.RecordBatch.from_pylist(out, schema=_FOUND)

    return run


FOUND = "id long, item_id long, score double, start long, end long"
_FOUND = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])


def contaminated_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = 0.5,
    least_words: int = 8,
    size: int = 3,
    bits: int = 22,
    probes: int = 2,
) -> DataFrame:
    """(id, item_id, score, start, end): the best aligned passage of a document per item.

    A passage counts when its alignment score reaches ``threshold`` of the item's words and
    ``least_words`` matches (all of a shorter item). Words are compared in lower case
    with ASCII punctuation stripped; ``start`` and ``end`` count such words. Every alignment
    that counts is found. Items with fewer than ``size`` words, null or empty ones match
    nothing; null and empty texts hold nothing. Rows that share an id (also those without
    one) are one document, equal items are reported each. Empty tables give an empty result.
    """
    if size < PAIR or least_words < PAIR:
        raise ValueError("an alignment that counts must hold two words")
    spark = docs.sparkSession
    items = stage(
        map_batches(
            benchmark.select(
                F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
            ).distinct(),
            _items(size, threshold, least_words),
            ITEMS,
        ).withColumn("item", F.xxhash64("item_id", "words")),
        "leak-items",
    )
    items = items.where("seeds > 0")

    def bitmap_of(grams: DataFrame):
        table = fill(grams.select(F.col("gram").alias("key"), F.lit(0).alias("number")).distinct(), bits, probes, 1)
        return spark.sparkContext.broadcast(np.packbits(table[:, 0].astype(bool), bitorder="little"))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = bitmap_of(items.select(F.explode("grams").alias("gram")))
    grams = items.select("item", "seeds", F.posexplode("grams").alias("position", "gram"))
    frequency = (
        map_batches(rows, _frequencies(asked, bits, probes), "gram long, docs long")
        .groupBy("gram")
        .agg(F.sum("docs").alias("docs"))
    )
    ranked = F.sort_array(F.collect_list(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "position", "gram")))
    seeds = (
        grams.join(frequency, "gram", "left")
        .groupBy("item", "seeds")
        .agg(ranked.alias("ranked"))
        .select("item", F.explode(F.slice("ranked", F.lit(1), F.col("seeds"))).alias("seed"))
        .where("seed.docs > 0")
        .select("item", "seed.gram")
        .distinct()
    )
    seeds = stage(seeds, "leak-seeds")
    asked.destroy()
    reach = items.agg(F.max("reach")).first()[0] or 0
    asked = bitmap_of(seeds)
    passages = stage(map_batches(rows, _passages(asked, bits, probes, reach), PASSAGES), "leak-passages")
    asked.destroy()
    shared = passages.select("passage", F.explode("grams").alias("gram")).join(seeds, "gram")
    candidates = (
        shared.select("passage", "item")
        .distinct()
        .join(passages.select("passage", "id", "start", "words").dropDuplicates(["passage"]), "passage")
        .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
    )
    aligned = map_batches(
        candidates.select("id", "item_id", "start", "words", "item_words"), _align(threshold, least_words), FOUND
    )
    best = F.max(F.struct(F.col("score"), -F.col("start"), F.col("end"))).alias("best")
    return (
        aligned.groupBy("id", "item_id")
        .agg(best)
        .select("id", "item_id", "best.score", (-F.col("best.col2")).alias("start"), F.col("best.end").alias("end"))
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose document holds no passage of ``benchmark``; all columns stay."""
    found = stage(contaminated_passages(docs, benchmark, id_col, **options).select("id").distinct(), "leak-found")
    return without_rows(docs, found, id_col)
