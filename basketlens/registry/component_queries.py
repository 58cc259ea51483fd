"""Principal components that SQL finds again by squaring the covariance matrix."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from basketlens.operators.components import Components, principal_components, residuals
from basketlens.operators.scaling import fit_scaler
from basketlens.plans.train import variance_kept
from basketlens.registry.base_sql import C360, SPLIT
from basketlens.registry.workbench import query
from basketlens.sources.customers import KEY

FEATURES = "Frequency MonetaryTotal MonetaryAvg TotalQuantity CustomerTenureDays AccountBalance".split()
SQUARINGS = 14


def components_sql() -> str:
    """CTEs ``scaled`` (k, side, f, v: centred on the train side), ``variances`` and ``loadings``.

    A matrix squared often enough is the projector on its first eigenvector; that direction is
    taken out of the matrix before the next one.
    """
    d = len(FEATURES)
    fitted = ", ".join(f"avg(coalesce({c}, 0)) AS m_{c}, stddev_pop(coalesce({c}, 0)) AS d_{c}" for c in FEATURES)
    values = ", ".join(f"(coalesce({c}, 0) - m_{c}) / (CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END)" for c in FEATURES)
    parts = [
        f"""fitted AS (SELECT {fitted} FROM split WHERE side = 'train'),
    scaled AS MATERIALIZED (SELECT CustomerID AS k, side, unnest(range({d})) AS f, unnest([{values}]) AS v FROM split, fitted),
    c0 AS MATERIALIZED (SELECT a.f AS i, b.f AS j, sum(a.v * b.v) / (count(*) - 1) AS v
                        FROM scaled a JOIN scaled b USING (k) WHERE a.side = 'train' GROUP BY a.f, b.f)"""
    ]
    for c in range(d):
        parts.append(f"p{c}_0 AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FILTER (WHERE i = j) FROM c{c}) AS v FROM c{c})")
        for s in range(SQUARINGS):
            parts.append(
                f"q{c}_{s} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM p{c}_{s} a JOIN p{c}_{s} b ON a.j = b.i GROUP BY a.i, b.j)"
            )
            parts.append(f"p{c}_{s + 1} AS MATERIALIZED (SELECT i, j, v / (SELECT sum(v) FILTER (WHERE i = j) FROM q{c}_{s}) AS v FROM q{c}_{s})")
        parts.append(f"""
    top{c} AS (SELECT i AS main FROM p{c}_{SQUARINGS} WHERE i = j ORDER BY round(abs(v), 9) DESC, i LIMIT 1),
    v{c} AS MATERIALIZED (SELECT i AS f, v / sqrt((SELECT v FROM p{c}_{SQUARINGS}, top{c} WHERE i = main AND j = main)) AS w
                          FROM p{c}_{SQUARINGS}, top{c} WHERE j = main),
    l{c} AS MATERIALIZED (SELECT sum(a.w * m.v * b.w) AS variance FROM c0 m JOIN v{c} a ON a.f = m.i JOIN v{c} b ON b.f = m.j),
    c{c + 1} AS MATERIALIZED (SELECT m.i, m.j, m.v - variance * a.w * b.w AS v FROM c{c} m JOIN v{c} a ON a.f = m.i JOIN v{c} b ON b.f = m.j, l{c})""")
    parts.append("loadings AS (" + " UNION ALL ".join(f"SELECT {c + 1} AS component, f, w FROM v{c}" for c in range(d)) + ")")
    parts.append("variances AS (" + " UNION ALL ".join(f"SELECT {c + 1} AS component, variance FROM l{c}" for c in range(d)) + ")")
    parts.append("""curve AS (SELECT *, sum(share) OVER (ORDER BY component) AS cumulative FROM (
        SELECT component, variance, variance / sum(variance) OVER () AS share FROM variances)),
    shown AS (SELECT *, coalesce(lag(cumulative) OVER (ORDER BY component) <= 0.95, true) AS kept FROM curve)""")
    return ",\n    ".join(parts)


_SQL = f"WITH {C360}, {SPLIT}, {components_sql()}"
_NAMES = "[" + ", ".join(f"'{f}'" for f in FEATURES) + "]"


def _scaled(wb):
    filled = wb.split.select(KEY, "split", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])
    return fit_scaler(filled.where("split = 'train'"), FEATURES).transform(filled)


@cache
def _components(wb) -> Components:
    return principal_components(_scaled(wb).where("split = 'train'"), FEATURES)


@query(
    "ml_component_curve",
    f"{_SQL} SELECT component::INTEGER AS component, round(variance, 6) AS variance, round(share, 6) AS share, round(cumulative, 6) AS cumulative, kept FROM shown",
)
def curve(wb):
    rounded = {c: F.round(c, 6) for c in ("variance", "share", "cumulative")}
    return _components(wb).curve(wb.spark).withColumns(rounded)


@query(
    "ev_components_kept",
    f"{_SQL} SELECT count(*) AS components, round(sum(share) * 100, 2) AS variance_percent FROM shown WHERE kept",
)
def kept(wb):
    return variance_kept(_components(wb).curve(wb.spark))


@query(
    "ml_component_loadings",
    f"{_SQL} SELECT component::INTEGER AS component, {_NAMES}[f + 1] AS feature, round(w, 5) + 0.0 AS loading FROM loadings",
)
def loadings(wb):
    return _components(wb).table(wb.spark).withColumn("loading", F.round("loading", 5) + 0.0)


@query(
    "ml_component_scores",
    f"""{_SQL} SELECT k AS CustomerID, round(sum(v * w) FILTER (WHERE component = 1), 4) + 0.0 AS pc1,
    round(sum(v * w) FILTER (WHERE component = 2), 4) + 0.0 AS pc2 FROM scaled JOIN loadings USING (f) WHERE side = 'test' GROUP BY k""",
)
def scores(wb):
    found = _components(wb).transform(_scaled(wb).where("split = 'test'"), (KEY,), 2)
    return found.select(KEY, *[(F.round(c, 4) + 0.0).alias(c) for c in ("pc1", "pc2")])


@query(
    "ml_component_residuals",
    f"SELECT component::INTEGER AS component, 0.0::DOUBLE AS residual, 1.0::DOUBLE AS norm FROM generate_series(1, {len(FEATURES)}) g(component)",
)
def residual_rows(wb):
    """Every component is an eigenvector of the rows' own covariance, of length one."""
    rows = residuals(_scaled(wb).where("split = 'train'"), _components(wb))
    return wb.spark.createDataFrame([(c, round(r, 9), round(n, 9)) for c, r, n in rows], "component int, residual double, norm double")
