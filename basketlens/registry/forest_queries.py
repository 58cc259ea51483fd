"""Forests that SQL grows again: nodes, scores, importances, choice and spend."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, functions as F

from basketlens.functions.risk import RISK_BOUNDS, RISK_LEVELS, decide, risk_level
from basketlens.operators.evaluate import roc_auc
from basketlens.operators.forest import DRAWN, Forest, grow_forest, library_forest
from basketlens.plans.prepare import select_by_importance
from basketlens.plans.train import churn_probability
from basketlens.registry.base_sql import C360, SPLIT, uniform_sql
from basketlens.registry.workbench import query
from basketlens.sources.customers import KEY, TARGET

FEATURES = (
    "Frequency MonetaryAvg TotalQuantity CustomerTenureDays AvgDaysBetweenPurchases ReturnRatio AccountBalance Age SatisfactionScore"
).split()
TREES, DEPTH, BINS, LEAST, TRIED, SEED = 4, 4, 12, 8, 4, 42
#: Features below this share of the importances are dropped.
THRESHOLD = 0.08


def _weight_sql(draw: str) -> str:
    cases = " ".join(f"WHEN u < {share} THEN {times}" for times, share in enumerate(DRAWN))
    return f"(SELECT CASE {cases} ELSE {len(DRAWN)} END FROM (SELECT {draw} AS u))"


def forest_sql(target: str, trees: int, depth: int, seed: int = SEED, name: str = "f") -> str:
    """CTEs that grow a forest level by level and score the test side: ``{name}_nodes``, ``{name}_scores``, ``{name}_importance``."""
    n, m = name, len(FEATURES)
    draw = f"(((t + 1) * 7919 + node * 104729 + (f + 1) * 1299709 + {seed})::BIGINT * 48271) % 2147483647"
    values = ", ".join(f"{c}::DOUBLE" for c in FEATURES)
    weight = _weight_sql(uniform_sql(f"tree{seed}", "t", "k")) if trees > 1 else "1"
    parts = [
        f"""{n}_rows AS (SELECT CustomerID AS k, side, Churn, {target} AS y, [{values}] AS x FROM split),
    {n}_long AS (SELECT k, side, unnest(range({m})) AS f, unnest(x) AS v FROM {n}_rows),
    {n}_cuts AS (SELECT f, list_sort(list_distinct(list_transform(quantile_cont(v, [{", ".join(f"{i / BINS!r}" for i in range(1, BINS))}]),
                 lambda q: round(q, 6)))) AS cuts FROM {n}_long WHERE side = 'train' GROUP BY f),
    {n}_coded AS (SELECT k, list(len(list_filter(cuts, lambda c: c < v)) ORDER BY f) AS codes FROM {n}_long JOIN {n}_cuts USING (f) GROUP BY k),
    {n}_bag AS (SELECT r.k, t, y, codes, {weight} AS w
                FROM {n}_rows r JOIN {n}_coded USING (k), range({trees}) g(t) WHERE side = 'train' AND y IS NOT NULL),
    {n}_at0 AS (SELECT *, 1 AS node FROM {n}_bag WHERE w > 0)"""
    ]
    for level in range(depth + 1):
        at = f"{n}_at{level}"
        parts.append(f"{n}_size{level} AS (SELECT t, node, sum(w)::BIGINT AS n, sum(w * y)::DOUBLE AS total FROM {at} GROUP BY t, node)")
        if level == depth:
            break
        parts.append(f"""
    {n}_tried{level} AS (SELECT t, node, f FROM {n}_size{level}, range({m}) h(f) QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY {draw}, f) <= {TRIED}),
    {n}_sums{level} AS (SELECT t, node, f, code, sum(n) OVER whole AS w, sum(g) OVER whole AS g, sum(n) OVER upto AS wl, sum(g) OVER upto AS gl
        FROM (SELECT a.t, a.node, f, codes[f + 1] AS code, sum(w)::DOUBLE AS n, sum(w * y)::DOUBLE AS g
              FROM {at} a JOIN {n}_tried{level} q ON q.t = a.t AND q.node = a.node GROUP BY ALL)
        WINDOW whole AS (PARTITION BY t, node, f), upto AS (PARTITION BY t, node, f ORDER BY code)),
    {n}_best{level} AS (SELECT t, node, f, code, gl * gl / wl + (g - gl) * (g - gl) / (w - wl) - g * g / w AS gain FROM {n}_sums{level}
        WHERE wl >= {LEAST} AND w - wl >= {LEAST} AND gl * gl / wl + (g - gl) * (g - gl) / (w - wl) - g * g / w > 0
        QUALIFY row_number() OVER (PARTITION BY t, node ORDER BY gain DESC, f, code) = 1),
    {n}_at{level + 1} AS (SELECT a.k, a.t, a.y, a.codes, a.w, 2 * a.node + (a.codes[b.f + 1] > b.code)::INTEGER AS node
        FROM {at} a JOIN {n}_best{level} b ON b.t = a.t AND b.node = a.node)""")
    sizes = " UNION ALL ".join(f"SELECT * FROM {n}_size{level}" for level in range(depth + 1))
    bests = " UNION ALL ".join(f"SELECT * FROM {n}_best{level}" for level in range(depth))
    parts.append(f"""
    {n}_sizes AS ({sizes}), {n}_bests AS ({bests}),
    {n}_nodes AS (SELECT s.t AS tree, s.node, coalesce(f, -1) AS feature, coalesce(code, -1) AS cut,
                         coalesce((SELECT cuts[code + 1] FROM {n}_cuts c WHERE c.f = b.f), 0.0) AS threshold, n, total, coalesce(gain, 0.0) AS gain
                  FROM {n}_sizes s LEFT JOIN {n}_bests b USING (t, node)),
    {n}_walk AS (
        SELECT k, codes, t, 1 AS node FROM {n}_rows JOIN {n}_coded USING (k), range({trees}) g(t)
        UNION ALL
        SELECT w.k, w.codes, w.t, 2 * w.node + (w.codes[b.f + 1] > b.code)::INTEGER FROM {n}_walk w JOIN {n}_bests b ON b.t = w.t AND b.node = w.node),
    {n}_scores AS (SELECT k, avg(total / n) AS p FROM (
        SELECT w.k, s.total, s.n FROM {n}_walk w JOIN {n}_sizes s ON s.t = w.t AND s.node = w.node
        WHERE NOT EXISTS (SELECT 1 FROM {n}_bests b WHERE b.t = w.t AND b.node = w.node)) GROUP BY k),
    {n}_shares AS (SELECT f, sum(share) AS share FROM (SELECT t, f, sum(gain) / sum(sum(gain)) OVER (PARTITION BY t) AS share FROM {n}_bests GROUP BY t, f) GROUP BY f),
    {n}_importance AS (SELECT f, coalesce(share, 0) / sum(share) OVER () AS importance FROM range({m}) h(f) LEFT JOIN {n}_shares USING (f))""")
    return ",\n    ".join(parts)


_CHURN = f"WITH RECURSIVE {C360}, {SPLIT}, {forest_sql('Churn', TREES, DEPTH)}"
_SPEND = f"WITH RECURSIVE {C360}, {SPLIT}, {forest_sql('round(MonetaryTotal * 100)::BIGINT', TREES, DEPTH)}"
_NAMES = "[" + ", ".join(f"'{f}'" for f in FEATURES) + "]"


def _sides(wb) -> tuple[DataFrame, DataFrame]:
    return tuple(wb.split.where(F.col("split") == side).drop("split") for side in ("train", "test"))


@cache
def _forest(wb, target: str, trees: int = TREES) -> Forest:
    train, _ = _sides(wb)
    cents = train.withColumn("cents", F.round(F.col("MonetaryTotal") * 100).cast("long"))
    return grow_forest(cents, KEY, target, FEATURES, trees, DEPTH, BINS, LEAST, TRIED, SEED)


@query(
    "ml_forest_nodes",
    f"{_CHURN} SELECT tree::INTEGER AS tree, node::BIGINT AS node, feature::INTEGER AS feature, cut::INTEGER AS cut, round(threshold, 3) AS threshold, n, total, round(gain, 6) AS gain FROM f_nodes",
)
def forest_nodes(wb):
    return _forest(wb, TARGET).table(wb.spark).withColumns({"gain": F.round("gain", 6), "threshold": F.round("threshold", 3)})


@query(
    "ml_forest_scores",
    f"""{_CHURN} SELECT CustomerID, Churn AS churn_actual, round(p, 9) AS churn_probability, (p >= 0.5)::INTEGER AS churn_predicted,
    CASE WHEN p <= 0.25 THEN 'Faible' WHEN p <= 0.5 THEN 'Moyen' WHEN p <= 0.75 THEN 'Élevé' ELSE 'Critique' END AS risk_level,
    (p >= 0.5)::INTEGER = Churn AS correct FROM split JOIN f_scores ON k = CustomerID WHERE side = 'test'""",
)
def forest_scores(wb):
    """Probability, decision, level and correctness of every test customer, all from the nodes."""
    p = F.col("churn_probability")
    found = _forest(wb, TARGET).predict(_sides(wb)[1], (KEY, TARGET), "churn_probability").withColumn("churn_predicted", decide(p))
    return found.select(
        KEY, F.col(TARGET).alias("churn_actual"), F.round(p, 9).alias("churn_probability"), "churn_predicted",
        # The lowest level takes 0 in, which a forest's leaves do reach.
        F.when(p <= RISK_BOUNDS[0], RISK_LEVELS[0]).otherwise(risk_level(p)).alias("risk_level"),
        (F.col("churn_predicted") == F.col(TARGET)).alias("correct"),
    )


@query(
    "ml_forest_importance",
    f"{_CHURN} SELECT {_NAMES}[f + 1] AS feature, round(importance, 9) + 0.0 AS importance, importance >= {THRESHOLD} AS kept FROM f_importance",
)
def forest_importance(wb):
    """Every feature's share of the gain, and whether the selection by importance keeps it."""
    shares = _forest(wb, TARGET).importances()
    kept = select_by_importance(shares, THRESHOLD)
    return wb.spark.createDataFrame([(f, round(v, 9) + 0.0, f in kept) for f, v in shares.items()], "feature string, importance double, kept boolean")


@query(
    "ml_forest_spend",
    f"{_SPEND} SELECT CustomerID, round(p / 100, 2) AS monetary_predicted FROM split JOIN f_scores ON k = CustomerID WHERE side = 'test'",
)
def forest_spend(wb):
    found = _forest(wb, "cents").predict(_sides(wb)[1], (KEY,), "cents")
    return found.select(KEY, F.round(F.col("cents") / 100, 2).alias("monetary_predicted"))


@query(
    "ml_forest_choice",
    f"""{_CHURN}, {forest_sql("Churn", 1, DEPTH, name="s")},
    scored AS (SELECT 'random_forest' AS model, Churn AS label, p FROM split JOIN f_scores ON k = CustomerID WHERE side = 'test'
               UNION ALL SELECT 'single_tree', Churn, p FROM split JOIN s_scores ON k = CustomerID WHERE side = 'test'),
    ranked AS (SELECT *, avg(place) OVER (PARTITION BY model, p) AS r FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY p) AS place FROM scored)),
    aucs AS (SELECT model, (sum(r) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                   / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS auc FROM ranked GROUP BY model)
    SELECT model, round(auc, 9) AS auc, row_number() OVER (ORDER BY auc DESC, model <> 'random_forest') = 1 AS chosen FROM aucs""",
)
def forest_choice(wb):
    """The model with the larger area under the curve on the test side, the forest where they tie."""
    rows = []
    for name, trees in (("random_forest", TREES), ("single_tree", 1)):
        scored = _forest(wb, TARGET, trees).predict(_sides(wb)[1], (KEY, TARGET), "p")
        rows.append((name, roc_auc(scored, TARGET, "p").first()["auc"]))
    best = min(rows, key=lambda r: (-r[1], r[0] != "random_forest"))[0]
    return wb.spark.createDataFrame([(n, round(v, 9), n == best) for n, v in rows], "model string, auc double, chosen boolean")


@query(
    "ml_library_nodes",
    f"""WITH {C360}, {SPLIT} SELECT CustomerID, 0.0::DOUBLE AS difference FROM split WHERE side = 'test'""",
)
def library_nodes(wb):
    """How far the node table of the trained churn forest is from the model's own probabilities."""
    forest = library_forest(wb.trained.forest, wb.trained.features, wb.spark)
    own = churn_probability(wb.prepared.test, wb.trained.forest, (KEY,))
    both = forest.predict(wb.prepared.test, (KEY,), "p").join(own, KEY)
    return both.select(KEY, F.round(F.abs(F.col("p") - F.col("churn_probability")), 6).alias("difference"))
