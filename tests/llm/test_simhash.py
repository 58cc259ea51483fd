"""Fingerprints, BK-trees and SimHash components against brute force, with odd rows."""

import random

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from basketlens.llm import simhash
from basketlens.llm.simhash import BKTree, fingerprint, hamming_links, simhash_duplicates, spanning

DOC = "doc_id long, text string"


def plain_fingerprint(text, k):
    words = brute.words(text)
    if not words:
        return 0
    shingles = [" ".join(words[j : j + k]) for j in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, k, radius):
    codes = [plain_fingerprint(t, k) for _, t in rows]
    links = [
        (rows[x][0], rows[y][0])
        for x in range(len(rows))
        for y in range(x)
        if rows[x][0] is not None and rows[y][0] is not None and (codes[x] ^ codes[y]).bit_count() <= radius
    ]
    part = brute.components({i for i, _ in rows if i is not None}, links)
    return [(i, f"{c:016x}", part.get(i)) for (i, _), c in zip(rows, codes, strict=True)]


def family(rng, n):
    base = [str(rng.randrange(10**6)) for _ in range(300)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(300)] = str(rng.randrange(10**6))
        rows.append((i, " ".join(own)))
    return rows


ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "A b"), (904, "a B"), (905, "a b c"), (None, "a b c"), (None, None)]
ODD += [(906, "one two three four"), (907, "ONE\x0btwo\x0cthree\rfour"), (908, "É é x y"), (3, "another text of document three")]


def test_fingerprints_of_long_and_short_texts(monkeypatch):
    rng = random.Random(3)
    texts = [None, "", "\n", "x", "x y", "x y z", "É É   A", " ".join(str(rng.randrange(50)) for _ in range(3000))]
    for run in (7, 64, 1 << 20):
        monkeypatch.setattr(simhash, "RUN", run)
        for width in (1, 3, 5):
            assert [fingerprint(t, width) for t in texts] == [plain_fingerprint(t, width) for t in texts]


def test_hash_is_that_of_the_engine(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two é")).alias("h")).first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest("one two é".encode(), seed=42) == fingerprint("One two é", 3)


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_tree_finds_all_within_radius(radius):
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, 1 << 10, 700).astype(np.uint64) | rng.integers(0, 4, 700).astype(np.uint64) << np.uint64(60))
    queries = rng.integers(0, 1 << 10, 60).astype(np.uint64)
    got = {(m, q) for m, near in BKTree(codes).search(queries, radius) for q in near.tolist()}
    assert got == {
        (m, q) for m in range(len(codes)) for q in range(len(queries)) if (int(codes[m]) ^ int(queries[q])).bit_count() <= radius
    }


def test_tree_follows_only_edges_within_radius():
    """Of 20 000 random codes a search sees few at radius 0."""
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    tree, seen = BKTree(codes), 0
    todo = [tree.root]
    while todo:
        node = todo.pop()
        if isinstance(node, np.ndarray):
            seen += len(node)
            continue
        seen += 1
        away = (int(codes[node[0]]) ^ int(codes[7])).bit_count()
        todo += [child for key, child in zip(node[1], node[2], strict=True) if key == away]
    assert seen < 500


def test_spanning_keeps_components():
    rng = np.random.default_rng(7)
    codes = np.unique(rng.integers(0, 1 << 14, 900).astype(np.uint64) << np.uint64(20))
    pairs = [(a, b) for a in range(len(codes)) for b in range(a) if (int(codes[a]) ^ int(codes[b])).bit_count() <= 2]
    want = brute.components(range(len(codes)), pairs)
    got = spanning(codes, 2)
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a in range(len(codes)) for b in range(0, a, 7))


@pytest.mark.parametrize("shard", [None, 20])
def test_links_meet_in_shards_that_are_dealt_again(spark, shard):
    rng = random.Random(8)
    codes = {rng.getrandbits(64) for _ in range(300)}
    crowd = rng.getrandbits(64)
    for _ in range(400):
        codes.add(crowd ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) % (1 << 64))
    codes = sorted(codes)
    table = [(c - (1 << 64) if c >> 63 else c, i) for i, c in enumerate(codes)]
    links = hamming_links(spark.createDataFrame(table, "code long, rep long"), 3, shard)
    got = brute.components(range(len(codes)), [(r["u"], r["v"]) for r in links.collect()])
    pairs = [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 3]
    assert got == brute.components(range(len(codes)), pairs)


@pytest.mark.parametrize("shard", [None, 16])
def test_components_match_brute_force(spark, shard):
    rng = random.Random(9)
    rows = family(rng, 120) + [(300 + i, " ".join(str(rng.randrange(30)) for _ in range(rng.randrange(12)))) for i in range(150)] + ODD
    rows += [(500, rows[0][1]), (500, rows[200][1]), (501, "x")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], DOC + ", code string").repartition(5)
    got = simhash_duplicates(df, words=3, shard=shard)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows, 3, 3), key=str)


def test_many_equal_texts_cost_one_code(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("same words in all of these")).alias("text"))
    got = simhash_duplicates(df, words=3).groupBy("fingerprint").agg(F.min("component_id").alias("c"), F.count("*").alias("n"))
    assert sorted((r["c"], r["n"]) for r in got.collect()) == [(0, 6667), (1, 13333)]


def test_no_rows(spark):
    assert simhash_duplicates(spark.createDataFrame([], DOC)).count() == 0
