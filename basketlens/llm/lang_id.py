"""Language identification with language-bitmask n-gram filters.

Learning counts letter trigrams per language over all labelled texts. A trigram belongs to
every language in which it is at least ``share`` as frequent as in the language that uses
it most. The trigrams go into a bit-sliced Bloom filter: one table of places, each a mask
with one bit per language, so one lookup returns all languages of a trigram. A text's
languages are counted bit by bit over its trigrams; each count is corrected for the false
positives that the fill of the language's slice lets expect, and the largest decides.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log1p, log2

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from basketlens.llm.bits import fill, places
from basketlens.llm.common import pieces
from basketlens.shipping import map_batches
from basketlens.staging import stage

_U = np.uint64
UNKNOWN = "und"
#: Trigram counts a task keeps before it passes them on.
HELD = 1 << 17
#: Text bytes handled at a time.
SLICE = 1 << 18

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(packed letter trigrams, text of each); other characters separate words, words are padded."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lowered], dtype=np.int64)
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letter_table()[codes]
    # One blank before and after each text.
    padded = np.full(len(codes) + 2 * len(texts), 32, dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(codes)) + 2 * owner + 1
    padded[at[letter]] = codes[letter]
    owner = np.repeat(np.arange(len(texts)), sizes + 2)
    blank = padded == 32
    first = np.ones(len(padded), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = ~blank | first
    keep[1:] |= blank[1:] & ~blank[:-1] & ~first[1:]
    padded, owner = padded[keep].astype(_U), owner[keep]
    if len(padded) < 3:
        return np.array([], dtype=_U), np.array([], dtype=np.int64)
    same = owner[2:] == owner[:-2]
    grams = (padded[:-2] << _U(42)) | (padded[1:-1] << _U(21)) | padded[2:]
    return grams[same], owner[2:][same]


def _count(apart: bool):
    """(lang, gram, n, texts) of labelled texts, combined in the task; texts that hold a trigram are counted if ``apart``."""

    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def emit():
            for lang, (grams, counts, texts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts), pa.array(texts)],
                    names=["lang", "gram", "n", "texts"],
                )
            held.clear()

        for piece in pieces(batches, "text", SLICE):
            langs = piece.column(1).dictionary_encode()
            grams, owner = trigrams(piece.column(0).to_pylist())
            of = langs.indices.to_numpy()[owner]
            for number, lang in enumerate(langs.dictionary.to_pylist()):
                own, at, counts = np.unique(grams[of == number], return_inverse=True, return_counts=True)
                texts = counts
                if apart and len(own):
                    once = np.unique(owner[of == number] * len(own) + at) % len(own)
                    texts = np.bincount(once, minlength=len(own))
                if lang in held:
                    own, at = np.unique(np.concatenate([held[lang][0], own]), return_inverse=True)
                    counts, texts = (
                        np.bincount(at, weights=np.concatenate([old, new])).astype(np.int64)
                        for old, new in zip(held[lang][1:], (counts, texts), strict=True)
                    )
                held[lang] = own, counts, texts
            if sum(len(g) for g, _, _ in held.values()) > HELD:
                yield from emit()
        yield from emit()

    return run


@dataclass
class LanguageFilter:
    """Masks of a bit-sliced Bloom filter and the false positive rate of each language's slice."""

    languages: list[str]
    fallback: str
    masks: np.ndarray
    bits: int
    probes: int

    def __post_init__(self) -> None:
        fills = np.array([self.slice(self.masks, k).mean() for k in range(len(self.languages))])
        self.false_positive = fills**self.probes

    @staticmethod
    def slice(masks: np.ndarray, number: int) -> np.ndarray:
        return (masks[:, number // 64] >> masks.dtype.type(number % 64)).astype(np.uint8) & 1

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """The mask of languages that hold each trigram."""
        found = None
        for place in places(grams, self.bits, self.probes):
            found = self.masks[place] if found is None else found & self.masks[place]
        return found

    def decide(self, texts: list[str]) -> tuple[list[str], list[float], list[float]]:
        grams, owner = trigrams(texts)
        sizes = np.bincount(owner, minlength=len(texts))
        masks = self.lookup(grams)
        corrected = np.zeros((len(self.languages), len(texts)))
        for k in range(len(self.languages)):
            counts = np.bincount(owner, weights=self.slice(masks, k), minlength=len(texts))
            expected = self.false_positive[k]
            corrected[k] = np.maximum(counts - sizes * expected, 0) / max(1 - expected, 1e-9)
        best = corrected.argmax(axis=0)
        top, total = corrected.max(axis=0), corrected.sum(axis=0)
        names, scores = [], []
        for i in range(len(texts)):
            if sizes[i] == 0:
                names.append(UNKNOWN)
                scores.append(0.0)
            elif top[i] <= 0:
                names.append(self.fallback)
                scores.append(0.0)
            else:
                names.append(self.languages[best[i]])
                scores.append(float(min(1.0, top[i] / total[i])))
        return names, scores, (top / np.maximum(sizes, 1)).tolist()


def held_out(identifier: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 1 modulo 3; a missing id is not held out."""
    return F.coalesce(F.crc32(identifier.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_languages(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    share: float = 0.25,
    bits: int = 20,
    probes: int = 3,
    max_languages: int = 1024,
    least_texts: int = 1,
    false_positive: float = 0.01,
) -> LanguageFilter | None:
    """Learn from every row of ``docs`` with a text and a language; None where there is none.

    The filter has ``2 ** bits`` places, or as many more as the language with the most
    trigrams needs for ``false_positive``; a place has a bit per language, in bytes of 1, 2, 4
    or 8 and multiples of 8. More than ``max_languages`` labels are an error, as
    a label column with that many values does not hold languages. With ``least_texts`` of 2 a
    trigram is learned only if another text of the language holds it too, so that no text
    vouches for itself.
    """
    labelled = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.where("text is not null and lang is not null")
    counts = stage(
        map_batches(labelled, _count(least_texts > 1), "lang string, gram long, n long, texts long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")),
        "lang-grams",
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = totals.orderBy("lang").limit(max_languages + 1).collect()
    if len(known) > max_languages:
        raise ValueError(f"more than {max_languages} language labels")
    if not known:
        return None
    languages = [r["lang"] for r in known]
    fallback = max(known, key=lambda r: (r["total"], r["lang"]))["lang"]
    numbered = docs.sparkSession.createDataFrame(
        [(r["lang"], i, float(r["total"])) for i, r in enumerate(known)], "lang string, number int, total double"
    )
    rates = counts.join(F.broadcast(numbered), "lang").select(
        "gram", "number", "texts", (F.col("n") / F.col("total")).alias("rate")
    )
    most = rates.groupBy("gram").agg(F.max("rate").alias("most"))
    members = rates.join(most, "gram").where((F.col("rate") >= share * F.col("most")) & (F.col("texts") >= least_texts))
    members = stage(members.select(F.col("gram").alias("key"), "number"), "lang-members")
    most = members.groupBy("number").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    # Independent probes meet set places only, at this rate, when a slice has this many places.
    bits = max(bits, ceil(log2(max(1, -probes * most / log1p(-(false_positive ** (1 / probes)))))))
    words = (len(languages) + 63) // 64
    kind = next((k for k in (np.uint8, np.uint16, np.uint32) if len(languages) <= np.iinfo(k).bits), _U)
    masks = fill(members, bits, probes, words, kind)
    return LanguageFilter(languages, fallback, masks, bits, probes)


def detect_languages(
    docs: DataFrame,
    learned: LanguageFilter | Broadcast | None,
    text_col: str = "text",
    carried: tuple[str, ...] | None = None,
) -> DataFrame:
    """(lang_pred, score, support, other): the language of every whole text.

    ``other`` holds the ``carried`` columns of ``docs``, all of them by default. ``learned`` may
    be broadcast already, so that the caller can destroy it once the result is written.

    Texts that are null or have no letter are ``und`` with score 0, as is every text when
    nothing was learned. A text whose trigrams no language holds gets the language with the
    most learned text and score 0. Ties go to the first language by name. The score is the
    winner's share of all corrected counts, the support its part of the text's trigrams.
    """
    rows = docs.select(
        F.col(text_col).cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carried is None else carried)]).alias("other"),
    )
    kind = rows.schema["other"].dataType.simpleString()
    if learned is None:
        return rows.select(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("support"), "other")
    shared = learned if isinstance(learned, Broadcast) else docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches):
        for piece in pieces(batches, "text", SLICE):
            names, scores, support = shared.value.decide([t or "" for t in piece.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(support, pa.float64()), piece.column(1)],
                names=["lang_pred", "score", "support", "other"],
            )

    return map_batches(rows, run, f"lang_pred string, score double, support double, other {kind}")
