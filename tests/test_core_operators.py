import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators.correlation import correlated_columns, correlation_matrix, high_correlation_pairs
from basketlens.operators import neighbours, pivots
from basketlens.operators.neighbours import nearest_neighbours
from basketlens.operators.ordering import running_totals
from basketlens.operators.quantiles import exact_quantiles
from basketlens.operators.smote import smote
from basketlens.operators.split import allocate, random_split, smallest_draw_cuts, stratified_split


def brute_force(keys, x, k):
    """Expected (key -> distances) by comparing everything."""
    out = {}
    for i, key in enumerate(keys):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        out[key] = np.sort(d)[:k]
    return out


def test_rings_rule_out_blocks_only_without_closer_rows(spark):
    """Every pair of blocks that holds a row within the radius is among the pairs, and far blocks are not."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(150, 3)), rng.normal(size=(150, 3)) + 50])
    rows = spark.createDataFrame([(i, 1, [float(v) for v in r]) for i, r in enumerate(x)], "rep long, copies long, vec array<double>")
    chosen = pivots.choose_references(rows, 40, guides=6)
    placed = pivots.place(rows, chosen, 20)
    of_blocks = pivots.rings(placed, chosen)
    assert of_blocks.agg(F.max("n"), F.sum("n")).first()[:] == (20, 300)
    radii = of_blocks.select("block", F.lit(1.5).alias("radius"))
    pairs = {(r["block"], r["other"]) for r in pivots.block_pairs(of_blocks, radii, chosen).collect()}
    block = {r["rep"]: r["block"] for r in placed.collect()}
    near = {(block[i], block[j]) for i in range(300) for j in range(300) if np.linalg.norm(x[i] - x[j]) <= 1.5 and block[i] != block[j]}
    assert near <= pairs
    sides = {b: {i < 150 for i in range(300) if block[i] == b} for b in set(block.values())}
    assert all(sides[a] & sides[b] for a, b in pairs)


def test_visits_in_twenty_columns_do_not_follow_the_rows(spark):
    """20 correlated columns, as scaled customer features are: few of many blocks are visited."""
    rng = np.random.default_rng(9)
    shares = []
    for n in (1000, 8000):
        x = rng.normal(size=(n, 4)) @ rng.normal(size=(4, 20)) + 0.01 * rng.normal(size=(n, 20))
        points = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "key long, vec array<double>")
        visits = []
        original = neighbours._visit
        try:
            neighbours._visit = lambda v, *rest: (visits.append(v.count()), original(v, *rest))[1]
            distinct, found = nearest_neighbours(points, 5, cell_rows=50)
            assert found.count() == 5 * n
        finally:
            neighbours._visit = original
        shares.append(sum(visits) / n / (n / 50))
    # Eight times the rows: about as many visits of each, not eight times as many.
    assert shares[1] < 0.3 * shares[0]


def test_visits_name_their_rows_and_are_dealt_over_tasks(spark, monkeypatch):
    """What a task lists holds no vectors, and a block's list in many parts gives the same neighbours."""
    rng = np.random.default_rng(10)
    x = rng.normal(size=(300, 6))
    points = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "key long, vec array<double>")
    listed, original = [], neighbours._visits
    monkeypatch.setattr(neighbours, "_visits", lambda *given: (listed.append(original(*given)), listed[-1])[1])
    found = []
    for rings in (neighbours.RINGS, 2):
        monkeypatch.setattr(neighbours, "RINGS", rings)
        _, near = nearest_neighbours(points, 5, cell_rows=20)
        found.append(sorted((r["rep"], r["rank"], tuple(r["neighbour"])) for r in near.collect()))
    assert found[0] == found[1] and len(found[0]) == 1500
    assert [sorted(v.columns) for v in listed] == [["away", "cell", "radius", "rep"]] * 2


@pytest.mark.parametrize("shape", ["normal", "skewed", "copies", "line"])
def test_neighbours_match_brute_force(spark, shape):
    rng = np.random.default_rng(7)
    n, d, k = 400, 4, 5
    x = rng.normal(size=(n, d))
    if shape == "skewed":
        x = np.exp(3 * x)
    if shape == "copies":  # a third of the rows is one vector, others come in small groups
        x = np.round(x, 0)
        x[: n // 3] = 1.0
    if shape == "line":
        x[:, 1:] = 0.0
    points = spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in enumerate(x)], "key long, vec array<double>")
    distinct, found = nearest_neighbours(points.repartition(5), k, cell_rows=16, visit_rows=7)
    rows = found.collect()
    of_vector = {tuple(r["vec"]): r["rep"] for r in distinct.collect()}
    by_rep = {}
    for r in rows:
        by_rep.setdefault(r["rep"], []).append((r["rank"], r["distance"], r["neighbour"]))
    expected = brute_force(range(n), x, k)
    for i in range(n):
        got = sorted(by_rep[of_vector[tuple(x[i])]], key=lambda t: t[0])
        assert [t[0] for t in got] == [1, 2, 3, 4, 5]
        np.testing.assert_allclose([t[1] for t in got], expected[i], atol=1e-12)
        for _, distance, vector in got:
            np.testing.assert_allclose(np.linalg.norm(x[i] - vector), distance, atol=1e-12)


@pytest.mark.parametrize("fetch_rows", [1, 50, 10_000])
def test_quantiles_are_exact(spark, fetch_rows):
    rng = np.random.default_rng(3)
    a = np.exp(rng.normal(size=1000) * 4)
    b = np.where(np.arange(1000) % 3 == 0, 5.0, rng.integers(0, 50, 1000))
    rows = [(float(u), float(v), None if i % 4 else float(u), float("nan") if i % 2 else 1.0) for i, (u, v) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("e", F.lit(None).cast("double"))
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(df, ["a", "b", "c", "d", "e"], probabilities, fetch_rows=fetch_rows)
    for p in probabilities:
        assert got["a"][p] == pytest.approx(np.quantile(a, p), rel=1e-12)
        assert got["b"][p] == pytest.approx(np.quantile(b, p), rel=1e-12)
        assert got["c"][p] == pytest.approx(np.quantile(a[::4], p), rel=1e-12)
        assert got["d"][p] == 1.0
        assert got["e"][p] is None


def test_running_totals_cross_slices(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.lit(1).alias("one"))
    rows = running_totals(df.repartition(7), [F.col("v").desc()], {"n": "one", "s": "v"}, groups=("g",)).collect()
    for g in range(3):
        mine = sorted((r for r in rows if r["g"] == g), key=lambda r: -r["v"])
        assert [r["n"] for r in mine] == list(range(1, len(mine) + 1))
        assert [r["s"] for r in mine] == list(np.cumsum([r["v"] for r in mine]))


@pytest.mark.parametrize("fetch_rows", [1, 40, 10_000])
def test_smallest_draws(spark, fetch_rows):
    from basketlens.functions.hashing import draw

    df = spark.range(500).select((F.col("id") % 2).cast("int").alias("stratum"), draw("t", "id").alias("draw"))
    by = {s: sorted(r["draw"] for r in df.collect() if r["stratum"] == s) for s in (0, 1)}
    cuts = smallest_draw_cuts(df, {0: (17, 250), 1: (249, 250)}, fetch_rows)
    assert cuts == {0: by[0][16], 1: by[1][248]}
    assert smallest_draw_cuts(df, {0: (0, 250), 1: (250, 250)}) == {0: "", 1: "~"}


def test_allocation_is_exact(spark):
    def allocated(counts):
        frame = spark.createDataFrame(list(counts.items()), "stratum int, rows long")
        return {r["stratum"]: r["k"] for r in allocate(frame, 0.2).collect()}

    assert allocated({0: 584 + 2334, 1: 291 + 1164}) == {0: 584, 1: 291}
    assert sum(allocated({0: 7, 1: 3, 2: 1}).values()) == 3


def test_split_is_the_same_for_any_partitioning(spark):
    df = spark.range(1001).select(F.col("id").alias("k"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    sides = []
    for n in (1, 4, 16):
        rows = stratified_split(df.repartition(n), "y", "k").where("split = 'test'").collect()
        sides.append({r["k"] for r in rows})
        assert len(rows) == 201
    assert sides[0] == sides[1] == sides[2]
    assert random_split(df, "k").where("split = 'test'").count() == 201


def test_correlation_with_gaps_and_constants(spark):
    import pandas as pd

    rng = np.random.default_rng(1)
    base = rng.normal(size=300)
    frame = pd.DataFrame(
        {
            "a": base * 1e6 + 5e7,
            "b": base + rng.normal(size=300) * 0.1,
            "c": np.where(rng.random(300) < 0.4, np.nan, base * 2 + rng.normal(size=300)),
            "d": np.full(300, 3.25),
            "e": np.where(np.arange(300) % 2 == 0, np.nan, 7.0),
            "f": np.where(rng.random(300) < 0.3, np.nan, rng.normal(size=300)),
        }
    )
    df = spark.createDataFrame(frame)
    got = correlation_matrix(df, list(frame.columns))
    expected = frame.corr().to_numpy()
    expected[:, [3, 4]] = np.nan
    expected[[3, 4], :] = np.nan
    np.testing.assert_allclose(got, expected, atol=1e-9)
    pairs = high_correlation_pairs(df, 0.8).collect()
    assert [(p["feature_1"], p["feature_2"]) for p in pairs][0] == ("a", "b")
    assert high_correlation_pairs(df.select("a", "d"), 0.8).collect() == []


def test_pruning_counts_dropped_predecessors(spark):
    """a~b and b~c are close, a~c is not: c still goes, because of the dropped b."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=2000)
    b = a + 0.5 * rng.normal(size=2000)
    c = b + 0.5 * rng.normal(size=2000)
    df = spark.createDataFrame([(float(u), float(v), float(w)) for u, v, w in zip(a, b, c)], "a double, b double, c double")
    r = np.corrcoef([a, b, c])
    assert r[0, 1] > 0.85 and r[1, 2] > 0.85 and r[0, 2] < 0.85
    assert correlated_columns(df, ["a", "b", "c"], 0.85) == ["b", "c"]


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i % 5 == 0), *map(float, rng.normal(size=3))) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, y int, a double, b double, c double")
    out = smote(df, ["a", "b", "c"], "y", "k", cell_rows=16).collect()
    by_class = {v: [r for r in out if r["y"] == v] for v in (0, 1)}
    assert len(by_class[0]) == len(by_class[1]) == 240
    x = {r[0]: np.array(r[2:]) for r in rows}
    members = [k for k, y, *_ in rows if y == 1]
    for r in by_class[1]:
        point = np.array([r["a"], r["b"], r["c"]])
        if r["copy"] == 0:
            np.testing.assert_array_equal(point, x[r["k"]])
            continue
        parent = x[r["k"]]
        near = sorted((np.linalg.norm(x[m] - parent), m) for m in members if m != r["k"])[:5]
        # On the segment between the parent and one of its five nearest neighbours.
        assert any(
            abs(np.linalg.norm(point - parent) + np.linalg.norm(point - x[m]) - d) < 1e-9 for d, m in near
        )
    again = {(r["k"], r["copy"], r["a"]) for r in smote(df.repartition(3), ["a", "b", "c"], "y", "k").collect()}
    assert again == {(r["k"], r["copy"], r["a"]) for r in out}


def test_smote_keeps_codes_whole(spark):
    rows = [(i, int(i % 4 == 0), float(i % 7), float(i % 3)) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, y int, a double, code double")
    out = smote(df, ["a", "code"], "y", "k", categorical=("code",)).where("copy > 0").collect()
    assert len(out) == 40 and {r["code"] for r in out} <= {0.0, 1.0, 2.0}


def test_smote_refuses_a_single_row(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0), (3, 1, 1.0)], "k long, y int, a double")
    with pytest.raises(ValueError):
        smote(df, ["a"], "y", "k")
