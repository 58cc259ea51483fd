"""Exact, line, near-duplicate and passage operators against brute force, with odd rows."""

import hashlib
import random
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from basketlens.llm import near_dedup, substring
from basketlens.llm.common import encoded, word_hashes
from basketlens.llm.components import connected_components
from basketlens.llm.cuckoo import CuckooFilter
from basketlens.llm.exact_dedup import CountingQuotientFilter, exact_duplicates, repeated_fingerprints
from basketlens.llm.line_dedup import LineIndex, deduplicate_lines
from basketlens.llm.near_dedup import near_duplicates
from basketlens.llm.substring import _places, matching_stretches, ranges, repeated_passages, wide_centres
from basketlens.staging import stage_path

DOC = "doc_id long, text string"
ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "A b"), (904, "a B"), (905, "a b c"), (None, "a b c"), (None, None)]


def word(rng):
    return str(rng.randrange(10**6))


def plain(rows):
    return sorted(rows, key=str)


# --- components -----------------------------------------------------------------------


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)] + [(400, 401), (401, 402), (402, 400)]
    links += [(a, b) for a, b in ((rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(120))]
    rng.shuffle(links)
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = connected_components(spark.createDataFrame([*links, (7, None), (None, None)], "u long, v long"))
    assert {r["node"]: r["component"] for r in got.collect()} == brute.components(nodes, [x for x in links if x[0] != x[1]])
    assert got.count() == len(nodes)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- near duplicates ------------------------------------------------------------------


def family(rng):
    base = [word(rng) for _ in range(200)]

    def edited(n):
        own = list(base)
        for _ in range(n):
            own[rng.randrange(len(own))] = word(rng)
        return " ".join(own)

    shared = " ".join(word(rng) for _ in range(60))
    rows = [(i, " ".join(base).upper()) for i in range(5)]
    rows += [(100 + i, edited(rng.randrange(4, 14))) for i in range(150)]
    rows += [(1000 + i, " ".join(word(rng) for _ in range(rng.randrange(20, 60))) + " " + shared) for i in range(120)]
    return rows


@pytest.mark.parametrize("block", [64, 512])
def test_near_duplicates_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = family(random.Random(3)) + ODD + [(905, "a b c")]
    got = near_duplicates(spark.createDataFrame(rows, DOC).repartition(5), words=4)
    assert plain(tuple(r) for r in got.collect()) == plain(brute.near(rows, 4, 80))


def test_rows_sharing_an_id_unite_their_links(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(word(rng) for _ in range(30)) for _ in range(3))
    rows = [(1, a), (5, a), (5, b), (3, b), (2, c), (2, b), (9, c)]
    got = near_duplicates(spark.createDataFrame(rows, DOC))
    assert {(r["id"], r["component_id"]) for r in got.collect()} == {(i, 1) for i in (1, 2, 3, 5, 9)}
    assert got.count() == len(rows)


def test_near_duplicates_of_nothing_and_of_other_columns(spark):
    empty = near_duplicates(spark.createDataFrame([], DOC))
    assert empty.columns == ["id", "n_shingles", "component_id", "kept"] and empty.count() == 0
    clash = spark.createDataFrame([(1, "x y z", 5, 6), (2, "x y z", 7, 8)], "doc_id long, text string, id long, component_id long")
    assert {(r["id"], r["component_id"]) for r in near_duplicates(clash).collect()} == {(1, 1), (2, 1)}


# --- exact duplicates -----------------------------------------------------------------


def exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(brute.lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[brute.lower(t)] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[brute.lower(t)]), i == keep, hashlib.sha256(brute.lower(t).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_duplicates_match_brute_force(spark, bits):
    rng = random.Random(5)
    rows = [(i, rng.choice(["x", "X", "É", "é", "long " * 3000, f"t{rng.randrange(40)}"])) for i in range(600)] + ODD + ODD
    got = exact_duplicates(spark.createDataFrame(rows, DOC).repartition(7), fingerprint_bits=bits)
    assert plain(tuple(r) for r in got.collect()) == plain(exact(rows))


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(spark.createDataFrame([], DOC)).count() == 0


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(6)
    keys = rng.integers(0, 2**63, 400, dtype=np.uint64)
    parts = [rng.choice(keys, 900) for _ in range(4)]
    filters = [CountingQuotientFilter.of(p, 42) for p in parts]
    merged = filters[0].merge(*filters[1:])
    want, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert (merged.fingerprints() == want).all() and (merged.counts == counts).all()
    again = [CountingQuotientFilter.from_bytes(42, *s.to_bytes()) for _, s in merged.segments(6)]
    assert (np.concatenate([s.fingerprints() for s in again]) == want).all()
    one = CountingQuotientFilter.of(np.array([], dtype=np.uint64), 42)
    assert len(one.merge(one).fingerprints()) == 0


def test_repeated_fingerprints_of_a_hot_key(spark):
    rows = spark.range(3000, numPartitions=6).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).cast("long").alias("print"))
    assert [tuple(r) for r in repeated_fingerprints(rows).collect()] == [(7, 1000)]


# --- lines ----------------------------------------------------------------------------


def texts(rng, n):
    pool = [f"shared line number {k}" for k in range(30)] + ["short", "", "  \t", "É" * 10, "x" * 9, " x" + "y" * 9, "Shared Line Number 3\r"]
    return [(i, "\n".join(rng.choice([rng.choice(pool), f"own line {i} {rng.random()}"]) for _ in range(rng.randrange(1, 12)))) for i in range(n)]


def shown(frame):
    return plain((r["id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in frame.collect())


@pytest.mark.parametrize("increments", [1, 3])
def test_lines_match_brute_force(spark, increments):
    rng = random.Random(7)
    rows = texts(rng, 200) + ODD + texts(rng, 3) + [(990, "shared line number 1\n" * 4000)]
    frame = spark.createDataFrame(rows, DOC).withColumn("id", F.lit(1)).withColumn("kept_text", F.lit("x"))
    got = deduplicate_lines(frame, increments=increments)
    assert shown(got) == plain(brute.lines(rows))
    assert {r["other"]["id"] for r in got.collect()} == {1}


def test_line_index_is_reversible(spark):
    rng = random.Random(8)
    one, two = texts(rng, 60), [(i + 1000, t) for i, t in texts(rng, 60)]
    frames = [spark.createDataFrame(r, DOC) for r in (one, two)]
    index = LineIndex(spark)
    index.insert(frames[0])
    index.insert(frames[1])
    with pytest.raises(ValueError, match="already"):
        index.insert(frames[1])
    assert shown(index.rewrite(frames[0].union(frames[1]))) == plain(brute.lines(one + two))
    index.delete(frames[0])
    assert shown(index.rewrite(frames[1])) == plain(brute.lines(two))
    index.insert(frames[0])
    assert shown(index.rewrite(frames[0].union(frames[1]))) == plain(brute.lines(one + two))


def test_line_index_grows_its_shards(spark):
    rows = [(i, f"a line of document {i}\nand one for {i // 2} and its twin") for i in range(300)]
    index = LineIndex(spark, keys_per_shard=8, shards=4)
    for part in (rows[:100], rows[100:]):
        index.insert(spark.createDataFrame(part, DOC))
    assert index.shards > 4
    assert shown(index.rewrite(spark.createDataFrame(rows, DOC))) == plain(brute.lines(rows))


def test_lines_of_nothing(spark):
    assert deduplicate_lines(spark.createDataFrame([], DOC)).count() == 0


def test_cuckoo_filter_holds_what_was_inserted():
    rng = np.random.default_rng(9)
    keys = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    held = CuckooFilter.for_keys(len(keys))
    held.insert(keys[:10_000])
    held.insert(keys[10_000:])
    assert held.contains(keys).all() and len(held) == len(keys)
    held = CuckooFilter.from_bytes(held.to_bytes())
    held.delete(keys[5_000:])
    assert held.contains(keys[:5_000]).all() and held.contains(keys[5_000:]).mean() < 0.01
    with pytest.raises(KeyError):
        CuckooFilter.for_keys(10).delete(keys[:1])


# --- passages -------------------------------------------------------------------------


def naive_windows(values, width):
    """(c, l, r) of every leftmost minimum at least ``width`` wide."""
    out = []
    for c, v in enumerate(values):
        left = max([j + 1 for j in range(c) if values[j] <= v], default=0)
        right = min([j - 1 for j in range(c + 1, len(values)) if values[j] < v], default=len(values) - 1)
        if right - left + 1 >= width:
            out.append((c, left, right))
    return out


@pytest.mark.parametrize("most", [5, 10**9])
def test_compact_windows_match_their_definition(most):
    rng = np.random.default_rng(10)
    for width in (1, 4, 9):
        values = rng.integers(0, most, 120)
        centres = wide_centres(values.astype(np.uint64), np.zeros(120, dtype=np.int64), width)
        # The nearest smaller value to the left may be as small; both bounds come from the centres.
        left, right = ranges(centres.tolist(), values[centres].tolist(), [0] * len(centres), [119] * len(centres))
        assert [(c, a, b) for c, a, b in zip(centres.tolist(), left, right, strict=True)] == naive_windows(values.tolist(), width)


def test_matching_stretches():
    a = np.arange(100, dtype=np.uint64)
    b = np.concatenate([np.arange(500, 530), np.arange(20, 80), np.arange(600, 640)]).astype(np.uint64)
    assert matching_stretches(a, b, 46) == [(20, 79, 30, 89, 1.0)]
    assert matching_stretches(a, b, 61) == []


def test_repeated_passages_find_every_exact_repeat(spark):
    rng = random.Random(11)
    pool = [" ".join(word(rng) for _ in range(n)) for n in (50, 51, 70, 300)]
    line = "one very common line of words"
    rows = []
    for i in range(300):
        parts = [" ".join(word(rng) for _ in range(rng.randrange(0, 120))), line, " ".join(["the"] * rng.randrange(0, 80))]
        if rng.random() < 0.5:
            parts.append(rng.choice(pool))
        rng.shuffle(parts)
        rows.append((i, "\n".join(parts)))
    rows += ODD + [(800, rows[0][1]), (801, " ".join([line] * 4000))]
    got = repeated_passages(spark.createDataFrame(rows, DOC).repartition(6)).collect()
    ids, pairs = brute.repeated([r for r in rows if r[0] is not None], 50)
    assert {i for r in got for i in (r["id"], r["other_id"])} == ids
    part = brute.components(ids, [(r["id"], r["other_id"]) for r in got])
    assert all(part[a] == part[b] for a, b in pairs)
    by_id = dict(rows)
    for r in got:
        own, other = brute.words(by_id[r["id"]])[r["start"] : r["end"]], brute.words(by_id[r["other_id"]])[r["other_start"] : r["other_end"]]
        assert len(own) >= 50 and (r["share"] < 1 or own == other or set(own) == set(other))


def test_repeats_are_linked_through_common_boilerplate(spark):
    rng = random.Random(15)
    text = lambda n: [word(rng) for _ in range(n)]
    rows = []
    for n in (36, 40, 44, 46):
        hot = text(n)
        for _ in range(60):
            rows.append(text(rng.randrange(5, 40)) + hot + text(rng.randrange(5, 40)))
        for _ in range(25):
            k = rng.randrange(51 - n)
            passage = text(k) + hot + text(50 - n - k)
            for _ in range(3):
                rows.append(text(rng.randrange(5, 40)) + passage + text(rng.randrange(5, 40)))
    rng.shuffle(rows)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    got = repeated_passages(spark.createDataFrame(rows, DOC).repartition(6)).collect()
    ids, pairs = brute.repeated(rows, 50)
    assert {i for r in got for i in (r["id"], r["other_id"])} == ids
    part = brute.components(ids, [(r["id"], r["other_id"]) for r in got])
    assert all(part[a] == part[b] for a, b in pairs)


def test_edited_passages_are_found_and_short_ones_are_not(spark):
    rng = random.Random(12)
    rows, edited = [], set()
    for i in range(0, 80, 2):
        passage = [word(rng) for _ in range(150)]
        copy = list(passage)
        copy[75] = "changed"
        rows.append((i, " ".join([word(rng) for _ in range(60)] + passage)))
        rows.append((i + 1, " ".join(copy + [word(rng) for _ in range(60)])))
        edited |= {i, i + 1}
    short = " ".join(word(rng) for _ in range(49))
    rows += [(1000 + i, " ".join(word(rng) for _ in range(40)) + " " + short) for i in range(20)]
    got = repeated_passages(spark.createDataFrame(rows, DOC)).collect()
    assert {i for r in got for i in (r["id"], r["other_id"])} == edited


def test_places_follow_the_diagonal():
    """Shingles that stand at several places are put where the others say."""
    a = np.array([7, 1, 2, 3, 7, 4, 5, 7, 7], dtype=np.uint64)
    assert _places(a, np.array([1, 7, 4], dtype=np.uint64), np.array([0, 3, 4])).tolist() == [1, 4, 5]
    assert _places(np.zeros(5, dtype=np.uint64), np.zeros(3, dtype=np.uint64), np.arange(3)).tolist() == [0, 1, 2]


def test_insertions_leave_one_row_for_a_pair(spark):
    """Passages on several diagonals are one stretch, reported once."""
    rng = random.Random(14)
    passage = [word(rng) for _ in range(200)]
    copy = passage[:90] + [word(rng), word(rng)] + passage[90:]
    rows = [(1, " ".join(passage)), (2, " ".join(copy))]
    (row,) = repeated_passages(spark.createDataFrame(rows, DOC)).collect()
    assert {row["id"], row["other_id"]} == {1, 2} and row["start"] == row["other_start"] == 0
    assert {row["end"], row["other_end"]} == {200, 202}


def test_every_text_of_an_id_is_compared(spark):
    """A shorter text of an id is linked too, at its own positions, and not to its own document."""
    rng = random.Random(12)
    passage = " ".join(word(rng) for _ in range(60))
    long = " ".join(word(rng) for _ in range(300))
    rows = [(1, long), (1, passage), (2, passage), (1, "x " + passage), (2, passage), (3, "y z " + passage)]
    got = {(r["id"], r["other_id"]) for r in repeated_passages(spark.createDataFrame(rows, DOC)).collect()}
    assert brute.components([1, 2, 3], got) == {1: 1, 2: 1, 3: 1}
    assert all(a != b for a, b in got)
    got = repeated_passages(spark.createDataFrame(rows[:3], DOC)).collect()
    assert {(r["id"], r["start"], r["end"]) for r in got} <= {(1, 0, 60), (2, 0, 60)} and got


def plain_stretch(a, b, words, least):
    """Whether some stretch of ``b`` of at least ``least`` words has 8 of 9 shingles in ``a``, the first and the last too."""
    held = {tuple(a[k : k + words]) for k in range(len(a) - words + 1)}
    agree = [tuple(b[k : k + words]) in held for k in range(len(b) - words + 1)]
    sums = [0]
    for x in agree:
        sums.append(sums[-1] + x)
    n = least - words + 1
    ends = [k for k, x in enumerate(agree) if x]
    return any((sums[j + 1] - sums[i]) * 9 >= (j + 1 - i) * 8 for i in ends for j in ends if j + 1 - i >= n)


def test_edited_passages_against_brute_force(spark):
    """Recall over passages of 60 to 150 words, an edit every 45 words, a third behind boilerplate that many hold."""
    rng = random.Random(13)
    boilerplate = [word(rng) for _ in range(30)]
    rows = []
    for i in range(0, 240, 2):
        passage = [word(rng) for _ in range(rng.randrange(60, 150))]
        copy = [word(rng) if k % 45 == 22 else w for k, w in enumerate(passage)]
        ahead = boilerplate if i % 6 == 0 else []
        rows.append((i, [word(rng) for _ in range(rng.randrange(40))] + ahead + passage + [word(rng) for _ in range(20)]))
        rows.append((i + 1, [word(rng) for _ in range(30)] + ahead + copy + [word(rng) for _ in range(rng.randrange(40))]))
    rows += [(1000 + i, [word(rng) for _ in range(40)] + boilerplate + [word(rng) for _ in range(40)]) for i in range(60)]
    want = {(a, b) for (a, x), (b, y) in zip(rows[:240:2], rows[1:240:2], strict=True) if plain_stretch(x, y, 5, 50)}
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], DOC).repartition(6)).collect()
    found = {(min(r["id"], r["other_id"]), max(r["id"], r["other_id"])) for r in got}
    assert len(want) > 60
    assert len(want & found) >= 0.9 * len(want)
    texts = dict(rows)
    assert all(plain_stretch(texts[r["other_id"]], texts[r["id"]], 5, 50) for r in got)


def test_edited_passages_that_are_mostly_boilerplate_are_linked(spark):
    """The centres of their keys hold the boilerplate alone; the two texts that share more must meet all the same."""
    rng = random.Random(21)
    text = lambda n: [word(rng) for _ in range(n)]
    rows, pairs = [], []
    for n in (30, 36, 40, 44):
        hot = text(n)
        rows += [text(rng.randrange(5, 40)) + hot + text(rng.randrange(5, 40)) for _ in range(60)]
        for _ in range(40):
            k = rng.randrange(61 - n)
            passage = text(k) + hot + text(60 - n - k)
            copy = list(passage)
            copy[rng.randrange(8, 52)] = "changed"
            pairs.append((len(rows), len(rows) + 1))
            rows += [text(rng.randrange(5, 40)) + p + text(rng.randrange(5, 40)) for p in (passage, copy)]
    want = {(a, b) for a, b in pairs if plain_stretch(rows[a], rows[b], 5, 50)}
    got = repeated_passages(spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], DOC).repartition(6)).collect()
    assert len(want) > 150
    assert len(want & {(min(r["id"], r["other_id"]), max(r["id"], r["other_id"])) for r in got}) >= 0.99 * len(want)
    assert all(plain_stretch(rows[r["other_id"]], rows[r["id"]], 5, 50) for r in got)


def test_a_passage_that_repeats_itself_is_linked():
    """Once in one text, several times in a row in the other: whichever is the group's centre."""
    rng = np.random.default_rng(3)
    once = rng.integers(1, 1 << 60, 56).astype(np.uint64)
    seam = rng.integers(1, 1 << 60, 4).astype(np.uint64)
    twice = np.concatenate([once, seam, once])
    assert sorted(matching_stretches(once, twice, 46)) == [(0, 55, 0, 55, 1.0), (0, 55, 60, 115, 1.0)]
    assert len(matching_stretches(twice, once, 46)) == 1
    edited = np.concatenate([once[:30], seam, once[34:], seam, once])
    assert {s[2:4] for s in matching_stretches(once, edited, 46)} == {(0, 55), (60, 115)}
    for held, own in ((50, 100), (46, 60), (60, 300)):
        (found, *_) = matching_stretches(np.full(held, 7, dtype=np.uint64), np.full(own, 7, dtype=np.uint64), 46)
        assert found == (0, held - 1, 0, held - 1, 1.0)


def test_repeats_within_a_text_lose_no_pair(spark):
    rng = random.Random(16)
    rows = []
    for i in range(0, 40, 2):
        passage = [word(rng) for _ in range(rng.randrange(52, 90))]
        rows.append((i, " ".join([word(rng) for _ in range(20)] + passage)))
        rows.append((i + 1, " ".join(passage * rng.randrange(2, 5) + [word(rng) for _ in range(20)])))
    rows += [(100 + n, " ".join([word(rng) for _ in range(9)] + [f"w{n % 5}"] * n + [word(rng) for _ in range(9)])) for n in range(50, 150, 3)]
    got = repeated_passages(spark.createDataFrame(rows, DOC).repartition(6)).collect()
    ids, pairs = brute.repeated(rows, 50)
    assert {i for r in got for i in (r["id"], r["other_id"])} == ids
    part = brute.components(ids, [(r["id"], r["other_id"]) for r in got])
    assert all(part[a] == part[b] for a, b in pairs)


def test_passages_of_nothing(spark):
    assert repeated_passages(spark.createDataFrame([], DOC)).count() == 0


def test_passages_keep_only_the_tables_that_their_result_reads(spark, monkeypatch):
    """The other staged tables are deleted, and every write removes its shuffle files."""
    setting, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(setting)

    def watched(df, name, *rest):
        seen.append((name, spark.conf.get(setting), stage_path(df, name, *rest)))
        return seen[-1][2]

    monkeypatch.setattr(substring, "stage_path", watched)
    monkeypatch.setattr(substring, "stage", lambda *given: watched(*given)[0])
    shared = " ".join(f"w{i}" for i in range(70))
    found = repeated_passages(spark.createDataFrame([(1, shared), (2, f"before {shared}"), (2, f"before {shared}")], DOC))
    assert {(r["id"], r["other_id"]) for r in found.collect()} & {(1, 2), (2, 1)}
    kept = {name for name, _, (_, path) in seen if Path(path.removeprefix("file:")).exists()}
    assert kept == {"passage-names", "passage-found"}
    assert len(seen) > 8 and all(value == "true" for _, value, _ in seen)
    assert spark.conf.get(setting) == before


def test_word_hashes_are_those_of_the_words_bytes():
    texts = ["Der  Ähre É", None, "", " \t", "x y x 日本", "last"]
    for column in (pa.array(texts, pa.string()), pa.array(["cut", *texts], pa.string()).slice(1)):
        hashes, counts = word_hashes(column)
        words = [w for t in texts for w in (t or "").replace("D", "d").split()]
        assert hashes.tolist() == [xxhash.xxh64_intdigest(w.encode()) for w in words]
        assert counts.tolist() == [3, 0, 0, 0, 4, 1]
    assert encoded(pa.array(["a", "", "é"]).slice(1)) == [b"", "é".encode()]
    assert encoded(pa.array([], pa.string())) == []


def test_window_minima_of_several_texts():
    rng = np.random.default_rng(4)
    for width in (1, 5, 46):
        values, owner = rng.integers(0, 30, 300).astype(np.uint64), np.sort(rng.integers(0, 6, 300))
        starts = [s for s in range(300 - width + 1) if owner[s] == owner[s + width - 1]]
        assert wide_centres(values, owner, width).tolist() == sorted({s + int(values[s : s + width].argmin()) for s in starts})
