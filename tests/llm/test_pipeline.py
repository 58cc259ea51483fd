"""The pipeline against plain versions of its stages, and the registered names."""

import collections
import math
import string

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from basketlens.llm.decontaminate import smith_waterman

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "identify_language", "deduplicate_repeated_lines", "drop_near_duplicates", "drop_contaminated", "mix",
    ]


def bare(text):
    words = [w.strip(string.punctuation) for w in text.lower().split()]
    return np.array([xxhash.xxh64_intdigest(w) for w in words if w], dtype=np.uint64)


def leaks(text, items):
    """Whether any item aligns anywhere in the text; every pair is aligned."""
    words = bare(text)
    for item in items:
        need = max(math.ceil(0.5 * len(item)), min(len(item), 8))
        if len(item) >= 3 and smith_waterman(words, item)[0] >= need:
            return True
    return False


def test_pipeline_matches_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(900_001, None, "en", "src0", 0), (900_002, "12 34 !", "en", "src1", 8), (900_003, "", "de", None, 0)], docs.schema
    )
    docs = docs.unionByName(odd)
    kept = {r["doc_id"]: r.asDict() for r in docs.collect()}
    bench = [bare(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    out = docs
    for name, function in corpus_pipeline.STAGES[:4]:
        before = {i: r["text"] for i, r in kept.items()}
        out = function(spark, out, SF)
        assert out.columns == docs.columns
        rows = {r["doc_id"]: r.asDict() for r in out.collect()}
        if name == "language":
            want = {i: t for i, t in before.items() if any(c.isalpha() for c in t or "")}
        elif name == "lines":
            want = {i: t for i, _, _, t in brute.lines(list(before.items()))}
        elif name == "near_duplicates":
            want = {i: before[i] for i, _, _, stays in brute.near(list(before.items()), 5, 80) if stays}
        else:
            want = {i: t for i, t in before.items() if not leaks(t, bench)}
        assert {i: r["text"] for i, r in rows.items()} == want, name
        assert len(rows) < len(before) or name in ("lines", "near_duplicates")
        assert all(r["n_chars"] == len(r["text"]) for r in rows.values()) or name == "language"
        kept = rows

    mixed = corpus_pipeline.mix(spark, out, SF).collect()
    assert {r["doc_id"]: r["size"] for r in mixed} == {i: len(brute.words(r["text"])) for i, r in kept.items()}
    taken, target = collections.Counter(), {}
    for r in mixed:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 64 for s in target)


def test_texts_of_no_language_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(3)
    noise = [" ".join("".join(rng.choice(list(string.ascii_lowercase), 6)) for _ in range(n)) for n in (5, 40)]
    foreign = ["Это русский текст о погоде", "Καλημέρα κόσμε, τι κάνεις", "これは日本語の文章です"]
    odd = [(900_000 + i, t, lang, "src0", len(t)) for i, t in enumerate(noise + foreign) for lang in ("en", None)]
    out = corpus_pipeline.identify_language(spark, docs.unionByName(spark.createDataFrame([(2 * r[0] + (r[2] is None), *r[1:]) for r in odd], docs.schema)), SF)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
        assert docs.count() == 0


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert 0 < got.count() <= 200 and got.where(F.col("doc_id").isNull()).count() == 0


@pytest.mark.parametrize("name", ["op2_language_id", "op5_decontaminate", "op7_personal_data", "op8_substring_dedup", "op10_minhash_near_dedup", "op11_simhash_near_dedup"])
def test_queries_without_sql_cover_the_whole_table(spark, name):
    got = contract.queries()[name](spark, SF)
    ids = {r["doc_id"] for r in got.select("doc_id").collect()}
    every = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    if name in ("op5_decontaminate", "op8_substring_dedup"):
        assert ids <= set(every)
    else:
        assert ids == set(every) and got.count() == len(every)
    if name == "op10_minhash_near_dedup":
        want = sorted(brute.near(list(every.items()), 4, 80))
        assert sorted(tuple(r) for r in got.collect()) == want
    if name == "op8_substring_dedup":
        want, _ = brute.repeated(list(every.items()), 51)
        others = {r["other_doc_id"] for r in got.select("other_doc_id").collect()}
        assert want <= ids | others


@pytest.mark.parametrize(
    ("stage", "operator"),
    [
        (corpus_pipeline.identify_language, "learn_languages"),
        (corpus_pipeline.deduplicate_repeated_lines, "deduplicate_lines"),
        (corpus_pipeline.drop_near_duplicates, "near_duplicates"),
        (corpus_pipeline.drop_contaminated, "remove_contaminated"),
    ],
)
def test_stages_hand_few_bytes_at_a_time_to_python(spark, monkeypatch, stage, operator):
    key, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key)

    def watched(*args, **options):
        texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 4096).alias("text"))
        size = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
        sizes.extend(r["n"] for r in texts.mapInArrow(size, "n long").collect())
        raise InterruptedError

    monkeypatch.setattr(corpus_pipeline, operator, watched)
    with pytest.raises(InterruptedError):
        stage(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    assert len(sizes) > 1 and max(sizes) < 5 << 20 and spark.conf.get(key) == before
