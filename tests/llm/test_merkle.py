"""Merkle manifests against a plain tree, with odd rows."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from basketlens.llm.merkle import MidstateTree, merkle_manifest

DOC = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def levels(nodes, fanout):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][k : k + fanout]) for k in range(0, len(found[-1]), fanout)])
    return found


def siblings(tree, place, fanout):
    found = []
    for nodes in tree[:-1]:
        first = place - place % fanout
        found += [x for k, x in enumerate(nodes[first : first + fanout], first) if k != place]
        place //= fanout
    return found


def refold(tree, place, value, fanout):
    for nodes in tree[:-1]:
        first = place - place % fanout
        run = nodes[first : first + fanout]
        run[place - first] = value
        value, place = digest(*run), place // fanout
    return value


def plain(rows, changed, fanout):
    """(id, leaf, subroot, root, siblings, folded root) of every row."""
    groups = {}
    for row, other in zip(rows, changed, strict=True):
        groups.setdefault(row[2], []).append((row[0], plain_leaf(row), plain_leaf(other)))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = levels([x[1] for x in groups[name]], fanout)
    top = levels([trees[name][-1][0] for name in names], fanout) if names else []
    out = []
    for at, name in enumerate(names):
        for place, (key, leaf, other) in enumerate(groups[name]):
            proof = siblings(trees[name], place, fanout) + siblings(top, at, fanout)
            folded = refold(top, at, refold(trees[name], place, other, fanout), fanout)
            out.append((key, leaf, trees[name][-1][0], top[-1][0], proof, folded))
    return out


def some_rows(rng, n):
    langs = ["en"] * 6 + ["é", "Z", "a", None, ""]
    rows = [(i, rng.choice(["s", None]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "ü x", "t" * 50])) for i in range(n)]
    rows += [(None, None, None, None, None), (None, "s", "en", 1, "x"), (3, "s", "en", 1, "other"), rows[5], rows[5], (-4, "s", "only", 7, "ein")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("fanout, height", [(2, 12), (2, 2), (3, 1), (5, 2)])
def test_manifest_matches_a_plain_tree(spark, fanout, height):
    rows = some_rows(random.Random(fanout * 10 + height), 150)
    df = spark.createDataFrame([(*r, "c", "d") for r in rows], DOC + ", root string, block string").repartition(6)
    changes = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    changed = [(*r[:3], r[3] + 1 if r[3] is not None and r[0] is not None and r[0] % 3 == 0 else r[3], r[4]) for r in rows]
    got = merkle_manifest(df, replaced={"n_chars": changes}, fanout=fanout, levels=height)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows, changed, fanout), key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9])
def test_sizes_around_full_trees(spark, n):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(n)]
    got = merkle_manifest(spark.createDataFrame(rows, DOC), levels=2).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows, rows, 2), key=str)
    assert all(r["folded_root"] == r["root"] for r in got)


def test_a_proof_leads_to_the_root(spark):
    """A changed value shows, and its own proof with the sizes of the runs gives the folded root."""
    rows = [(i, "s", "en", i, "t") for i in range(64)]
    df = spark.createDataFrame(rows, DOC)
    got = merkle_manifest(df, replaced={"text": F.when(F.col("doc_id") == 9, "forged").otherwise(F.col("text"))}).collect()
    assert [r["id"] for r in got if r["folded_root"] != r["root"]] == [9]
    (row,) = [r for r in got if r["id"] == 9]
    value, place = plain_leaf((9, "s", "en", 9, "forged")), 9
    for other in row["siblings"]:
        value, place = digest(value, other) if place % 2 == 0 else digest(other, value), place // 2
    assert value == row["folded_root"]


def test_states_are_resumed_without_left_siblings(monkeypatch):
    nodes = [digest(str(k)) for k in range(9)]
    tree = MidstateTree(list(nodes), 3, 2)
    want = refold(levels(nodes, 3), 5, "x", 3)
    for row in tree.rows[:-1]:
        for k in range(len(row)):
            if k not in (5, 2):
                row[k] = row[k] if k > {0: 5, 1: 1}[tree.rows.index(row)] else "gone"
    assert tree.fold(5, "x") == want


def test_one_group_holds_most_rows(spark):
    """Blocks bound what a task holds: a hot group's leaves lie in many blocks."""
    df = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % 3 > 0, "en").otherwise("fr").alias("lang"),
        F.col("id").alias("n_chars"), F.lit("t").alias("text"),
    )
    rows = [tuple(r) for r in df.collect()]
    got = {r["id"]: r for r in merkle_manifest(df, levels=4).collect()}
    want = plain(rows, rows, 2)
    assert all((got[w[0]]["root"], got[w[0]]["siblings"], got[w[0]]["folded_root"]) == (w[3], w[4], w[5]) for w in want)


def test_no_rows(spark):
    assert merkle_manifest(spark.createDataFrame([], DOC)).count() == 0
