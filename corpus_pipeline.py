"""Corpus preparation: language, repeated lines, near duplicates, benchmark leaks, source mix.

Every stage takes all documents the one before it kept and returns the columns of
``documents``; the last returns the mix. ``run`` writes each stage's result in the shared
folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.llm.common import table, without_rows
from basketlens.llm.decontaminate import remove_contaminated
from basketlens.llm.lang_id import UNKNOWN, detect_languages, learn_languages
from basketlens.llm.line_dedup import deduplicate_lines
from basketlens.llm.mixing import mix_sources
from basketlens.llm.near_dedup import near_duplicates
from basketlens.shipping import batch_bytes
from basketlens.staging import discard, stage, stage_path


#: The part of a text's trigrams that its language must hold: random letters reach 0.13, texts of the given tables 0.55 at least.
SUPPORT = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be identified; null texts, texts without a letter and texts of no language go.

    A language counts if it holds ``SUPPORT`` of the text's trigrams, learned from other texts too.
    """
    with batch_bytes(spark):
        learned = learn_languages(docs, least_texts=2)
    shared = learned and spark.sparkContext.broadcast(learned)
    # Only the text and what names the row pass through the filter; the rows to drop are few.
    named = docs.withColumn("same", F.xxhash64("text"))
    found = detect_languages(named, shared, carried=("doc_id", "same"))
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("support") >= SUPPORT)
    with batch_bytes(spark):
        dropped = stage(found.where(~known).select("other.*").distinct(), "pipeline-unknown")
    if shared:
        shared.destroy()
    gone = dropped.select(F.struct(*dropped.columns).alias("id"))
    return without_rows(named.withColumn("row", F.struct("doc_id", "same")), gone, "row").select(*docs.columns)


def deduplicate_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a document with a smaller id holds; n_chars follows the text."""
    with batch_bytes(spark):
        found = deduplicate_lines(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return found.select(*[(changed[c] if c in changed else F.col(f"other.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; the rows of one id stay together."""
    with batch_bytes(spark):
        dropped = stage(near_duplicates(docs).where(~F.col("kept")).select("id").distinct(), "pipeline-near")
    return without_rows(docs, dropped, "doc_id")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    with batch_bytes(spark):
        return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): the words the mix takes of each document."""
    return mix_sources(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", identify_language),
    ("lines", deduplicate_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mix", mix),
]

#: SQL states neither language filters nor alignments; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, function in STAGES:
        docs, path = stage_path(function(spark, docs, sf_dir), f"pipeline-{name}")
        discard(spark, *before)
        before = [path]
    return docs
