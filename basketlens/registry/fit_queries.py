"""Operators that learn from training rows, and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.operators import encode, evaluate, profile, scaling
from basketlens.operators.correlation import correlated_columns
from basketlens.operators.smote import smote
from basketlens.operators.split import random_split
from basketlens.plans.prepare import feature_importance
from basketlens.registry.base_sql import C360, SCORED, SPEND, SPLIT, uniform_sql
from basketlens.registry.workbench import NUMERIC, query
from basketlens.sources.customers import KEY, TARGET, write_table

TEXTS = ["Country", "Region", "OrderPriority", "Gender"]
NUMBERS = NUMERIC
SMOTE_FEATURES = ["Frequency", "MonetaryTotal", "TotalQuantity", "CustomerTenureDays", "AccountBalance"]

_CODES = "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", v AS \"value\", (row_number() OVER (ORDER BY v) - 1)::INTEGER AS code "
    f"FROM (SELECT DISTINCT coalesce({c}, 'Inconnu') AS v FROM src)"
    for c in TEXTS
)


def _train(wb):
    return wb.split.where("split = 'train'").drop("split")


def _test(wb):
    return wb.split.where("split = 'test'").drop("split")


@query("fit_label_encode", f"WITH {C360}, src AS (SELECT * FROM c360) {_CODES}")
def label_codes(wb):
    return encode.fit_labels(wb.customers, TEXTS)


@query(
    "fit_encode_unseen",
    f"""WITH {C360}, {SPLIT}, src AS (SELECT * FROM split WHERE side = 'train' AND Country NOT IN ('NATION_3', 'NATION_7')),
    codes AS ({_CODES})
    SELECT s.CustomerID, coalesce(a.code, 0) AS Country, coalesce(b.code, 0) AS Gender FROM split s
    LEFT JOIN codes a ON a."column" = 'Country' AND a."value" = coalesce(s.Country, 'Inconnu')
    LEFT JOIN codes b ON b."column" = 'Gender' AND b."value" = coalesce(s.Gender, 'Inconnu') WHERE side = 'test'""",
)
def unseen_codes(wb):
    train = _train(wb).where(~F.col("Country").isin("NATION_3", "NATION_7")).select(KEY, "Country", "Gender")
    _, coded, _ = encode.encode_pair(train, _test(wb).select(KEY, "Country", "Gender"))
    return coded


_IMPUTED = ["Age", "AvgDaysBetweenPurchases", "SatisfactionScore", "MonetaryTotal"]


@query(
    "fit_median_impute",
    f"""WITH {C360}, {SPLIT}, med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _IMPUTED)} FROM split WHERE side = 'train')
    SELECT CustomerID, side AS split, {", ".join(f"round(coalesce({c}, m_{c}), 4) AS {c}" for c in _IMPUTED)} FROM split, med""",
)
def imputed(wb):
    train, test = (side.select(KEY, *_IMPUTED) for side in (_train(wb), _test(wb)))
    medians = scaling.train_medians(train, _IMPUTED, test)
    both = scaling.impute(train, medians).withColumn("split", F.lit("train")).unionByName(
        scaling.impute(test, medians).withColumn("split", F.lit("test"))
    )
    return both.select(KEY, "split", *[F.round(c, 4).alias(c) for c in _IMPUTED])


_PRUNE = (
    "SELECT unnest(["
    + ", ".join(f"{{'column': '{b}', 'r': abs(corr({a}, {b}))}}" for j, b in enumerate(NUMBERS) for a in NUMBERS[:j])
    + "], recursive := true) FROM split WHERE side = 'train'"
)


@query(
    "fit_corr_prune",
    f"""WITH {C360}, {SPLIT}, r AS ({_PRUNE}) SELECT DISTINCT "column" FROM r WHERE r > 0.85 AND NOT isnan(r)""",
)
def pruned(wb):
    gone = correlated_columns(_train(wb), NUMBERS, 0.85)
    return wb.spark.createDataFrame([(c,) for c in gone], "column string")


@query("fit_importance")
def importances(wb):
    train = scaling.impute(_train(wb), scaling.train_medians(_train(wb), NUMBERS))
    found = feature_importance(train, NUMBERS, TARGET)
    return wb.spark.createDataFrame(
        [(f, v, v >= 0.005) for f, v in found.items()], "feature string, importance double, kept boolean"
    )


@query("fit_stratified_split", f"WITH {C360}, {SPLIT} SELECT CustomerID, Churn, side AS split FROM split")
def stratified(wb):
    return wb.split.select(KEY, TARGET, "split")


@query(
    "fit_random_split",
    f"""WITH {C360} SELECT CustomerID, CASE WHEN row_number() OVER (ORDER BY md5('split42|' || CustomerID))
    <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM c360""",
)
def plain_split(wb):
    return random_split(wb.customers, KEY).select(KEY, "split")


_SMOTE_LIST = ", ".join(f"coalesce({c}, 0)::DOUBLE" for c in SMOTE_FEATURES)
_SMOTE_SQL = f"""
tr AS (SELECT CustomerID AS k, Churn, [{_SMOTE_LIST}] AS x FROM split WHERE side = 'train'),
m AS (SELECT k, x, row_number() OVER (ORDER BY md5('smote42|' || k)) AS rn FROM tr WHERE Churn = 1),
gap AS (SELECT count(*) FILTER (WHERE Churn = 0) - count(*) FILTER (WHERE Churn = 1) AS need, count(*) FILTER (WHERE Churn = 1) AS n FROM tr),
nn AS (SELECT a.k, b.x AS nx, row_number() OVER (PARTITION BY a.k ORDER BY list_distance(a.x, b.x), b.k) AS r
       FROM m a JOIN m b ON a.k <> b.k QUALIFY r <= 5),
made AS (SELECT m.k, m.x, unnest(generate_series(1, (need // n + CASE WHEN rn <= need % n THEN 1 ELSE 0 END)::BIGINT)) AS copy FROM m, gap),
drawn AS (SELECT made.*, nx, {uniform_sql("gap42", "made.k", "copy")} AS g FROM made
          JOIN nn ON nn.k = made.k AND nn.r = floor({uniform_sql("rank42", "made.k", "copy")} * 5) + 1)
"""


@query(
    "fit_smote",
    f"""WITH {C360}, {SPLIT}, {_SMOTE_SQL}
    SELECT k AS CustomerID, 0 AS copy, Churn, {", ".join(f"round(x[{i}], 4) AS {c}" for i, c in enumerate(SMOTE_FEATURES, 1))} FROM tr
    UNION ALL SELECT k, copy, 1, {", ".join(f"round(x[{i}] + g * (nx[{i}] - x[{i}]), 4)" for i in range(1, len(SMOTE_FEATURES) + 1))} FROM drawn""",
)
def oversampled(wb):
    filled = _train(wb).select(KEY, TARGET, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in SMOTE_FEATURES])
    out = smote(filled, SMOTE_FEATURES, TARGET, KEY)
    return out.select(KEY, "copy", TARGET, *[F.round(c, 4).alias(c) for c in SMOTE_FEATURES])


_SCALED = NUMERIC


@query(
    "fit_standard_scale",
    f"""WITH {C360}, {SPLIT}, s AS (SELECT {", ".join(f"avg(coalesce({c}, 0)) AS m_{c}, stddev_pop(coalesce({c}, 0)) AS d_{c}" for c in _SCALED)}
      FROM split WHERE side = 'train')
    SELECT CustomerID, side AS split, {", ".join(f"round((coalesce({c}, 0) - m_{c}) / (CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END), 6) AS {c}" for c in _SCALED)}
    FROM split, s""",
)
def scaled(wb):
    filled = wb.split.select(KEY, "split", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in _SCALED])
    scaler = scaling.fit_scaler(filled.where("split = 'train'"), _SCALED)
    return scaler.transform(filled).select(KEY, "split", *[F.round(c, 6).alias(c) for c in _SCALED])


_ALL_LIST = ", ".join(f"(coalesce({c}, 0) - m_{c}) / (CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END)" for c in _SCALED)
_SMOTE_SCALED_SQL = _SMOTE_SQL.replace(
    f"tr AS (SELECT CustomerID AS k, Churn, [{_SMOTE_LIST}] AS x FROM split WHERE side = 'train')",
    f"""fitted AS (SELECT {", ".join(f"avg(coalesce({c}, 0)) AS m_{c}, stddev_pop(coalesce({c}, 0)) AS d_{c}" for c in _SCALED)}
               FROM split WHERE side = 'train'),
    tr AS (SELECT CustomerID AS k, Churn, [{_ALL_LIST}] AS x FROM split, fitted WHERE side = 'train')""",
)


@query(
    "fit_smote_scaled",
    f"""WITH {C360}, {SPLIT}, {_SMOTE_SCALED_SQL}
    SELECT k AS CustomerID, 0 AS copy, Churn, {", ".join(f"round(x[{i}], 4) + 0.0 AS {c}" for i, c in enumerate(_SCALED, 1))} FROM tr
    UNION ALL SELECT k, copy, 1, {", ".join(f"round(x[{i}] + g * (nx[{i}] - x[{i}]), 4) + 0.0" for i in range(1, len(_SCALED) + 1))} FROM drawn""",
)
def oversampled_scaled(wb):
    """Neighbours in all numeric columns, each scaled to the same weight."""
    filled = _train(wb).select(KEY, TARGET, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in _SCALED])
    scaled_rows = scaling.fit_scaler(filled, _SCALED).transform(filled)
    out = smote(scaled_rows, _SCALED, TARGET, KEY)
    return out.select(KEY, "copy", TARGET, *[(F.round(c, 4) + 0.0).alias(c) for c in _SCALED])


_SPEND_INPUTS = [c for c in NUMERIC if c != "MonetaryTotal"]


@query(
    "fit_regression_scale",
    f"""WITH {C360}, p AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('split42|' || CustomerID))
      <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS side FROM c360 WHERE MonetaryTotal IS NOT NULL),
    s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in _SPEND_INPUTS)} FROM p WHERE side = 'train')
    SELECT CustomerID, side AS split,
      {", ".join(f"round(({c} - m_{c}) / (CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END), 6) + 0.0 AS {c}" for c in _SPEND_INPUTS)} FROM p, s""",
)
def regression_scaled(wb):
    rows = wb.customers.where(F.col("MonetaryTotal").isNotNull()).select(KEY, *_SPEND_INPUTS)
    parts = random_split(rows, KEY)
    scaler = scaling.fit_scaler(parts.where("split = 'train'"), _SPEND_INPUTS)
    return scaler.transform(parts).select(KEY, "split", *[(F.round(c, 6) + 0.0).alias(c) for c in _SPEND_INPUTS])


@query(
    "fit_class_weights",
    f"""WITH {C360}, {SPLIT}, c AS (SELECT Churn, count(*) AS n FROM split WHERE side = 'train' GROUP BY 1)
    SELECT Churn AS class, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c""",
)
def weights(wb):
    return scaling.class_weights(_train(wb), TARGET).withColumn("weight", F.round("weight", 6))


@query(
    "fit_prepare",
    f"""WITH {C360}, {SPLIT}, n AS (SELECT side, Churn, count(*) AS n FROM split GROUP BY 1, 2)
    SELECT side, Churn, CASE WHEN side = 'train' THEN max(n) OVER (PARTITION BY side) ELSE n END AS n FROM n""",
)
def preparation_job(wb):
    """Rows per side and class after the whole preparation: train balanced, test as it was."""
    sides = [
        wb.prepared.train.select(F.lit("train").alias("side"), TARGET),
        wb.prepared.test.select(F.lit("test").alias("side"), TARGET),
    ]
    return sides[0].unionByName(sides[1]).groupBy("side", TARGET).agg(F.count("*").alias("n"))


@query(
    "pro_balance",
    f"""WITH {C360}, {SPLIT}, n AS (SELECT Churn AS class, count(*) AS n FROM split WHERE side = 'train' GROUP BY 1)
    SELECT 'before' AS stage, class, n, round(n / sum(n) OVER (), 6) AS share FROM n
    UNION ALL SELECT 'after', class, max(n) OVER (), 0.5 FROM n""",
)
def balanced_shares(wb):
    return profile.balance(_train(wb), wb.prepared.train).withColumn("share", F.round("share", 6))


_SIDE_CODES = "\nUNION ALL ".join(
    f"SELECT '{c}' AS field, v, (row_number() OVER (ORDER BY v) - 1)::DOUBLE AS code "
    f"FROM (SELECT DISTINCT coalesce({c}, 'Inconnu') AS v FROM split WHERE side = 'train')"
    for c in TEXTS
)
_CODE = "coalesce((SELECT code FROM codes WHERE field = '{c}' AND v = coalesce(s.{c}, 'Inconnu')), 0) AS {c}"


@query(
    "snk_processed_table",
    f"""WITH {C360}, {SPLIT}, codes AS ({_SIDE_CODES}),
    q AS (SELECT quantile_cont(MonetaryTotal, 0.01) AS lo, quantile_cont(MonetaryTotal, 0.99) AS hi FROM split WHERE side = 'train'),
    d AS (SELECT *, coalesce(try_strptime(RegistrationDate, '%d/%m/%y'), try_strptime(RegistrationDate, '%Y-%m-%d'),
      try_strptime(RegistrationDate, '%d/%m/%Y'), try_strptime(RegistrationDate, '%m/%d/%Y'))::DATE AS day,
      CASE WHEN MonetaryTotal IS NOT NULL THEN least(greatest(MonetaryTotal, lo), hi) END AS clipped FROM split, q)
    SELECT CustomerID, Churn, side AS split, Frequency::DOUBLE AS Frequency, round(clipped, 4) AS MonetaryTotal, Age,
    CASE WHEN SupportTicketsCount BETWEEN 0 AND 15 THEN SupportTicketsCount END AS SupportTicketsCount,
    CASE WHEN SatisfactionScore BETWEEN 1 AND 5 THEN SatisfactionScore END AS SatisfactionScore,
    {", ".join(_CODE.format(c=c) for c in TEXTS)},
    year(day)::DOUBLE AS RegYear, month(day)::DOUBLE AS RegMonth, day(day)::DOUBLE AS RegDay, (isodow(day) - 1)::DOUBLE AS RegWeekday,
    coalesce(try_cast(split_part(LastLoginIP, '.', 1) AS INTEGER) IN (10, 127, 172, 192), false)::INTEGER::DOUBLE AS IP_IsPrivate,
    UniqueProducts / (TotalTransactions + 1) AS DiversityRatio, CancelledTransactions / (TotalTransactions + 1) AS CancelRate,
    round(clipped / (Frequency + 1), 4) AS AvgBasket FROM d s""",
)
def processed_table(wb):
    """Cleaned, engineered and encoded rows, with everything fitted on the training side."""
    kept = [KEY, TARGET, "split", "Frequency", "Age", "SupportTicketsCount", "SatisfactionScore", *TEXTS, "RegYear", "RegMonth",
            "RegDay", "RegWeekday", "IP_IsPrivate", "DiversityRatio", "CancelRate"]
    path = write_table(wb.prepared.processed, wb.path("processed"), partition_by=("split",))
    # Halves by the binary number, as SQL rounds them.
    rounded = [(F.round(F.col(c) * 10_000) / 10_000).alias(c) for c in ("MonetaryTotal", "AvgBasket")]
    return wb.spark.read.parquet(path).select(*kept, *rounded)


@query(
    "ev_accuracy",
    f"WITH {C360}, {SCORED} SELECT count(*) AS n, round(avg(correct::INTEGER), 6) AS accuracy FROM report",
)
def accuracy(wb):
    return evaluate.accuracy(wb.report, "label", "churn_predicted").withColumn("accuracy", F.round("accuracy", 6))


@query(
    "ev_confusion",
    f"""WITH {C360}, {SCORED} SELECT a AS actual, p AS predicted, (SELECT count(*) FROM report WHERE label = a AND churn_predicted = p) AS n
    FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(p)""",
)
def confusion(wb):
    return evaluate.confusion_matrix(wb.report, "label", "churn_predicted")


@query(
    "ev_class_report",
    f"""WITH {C360}, {SCORED}, k AS (SELECT c, count(*) FILTER (WHERE label = c AND churn_predicted = c) AS tp,
      count(*) FILTER (WHERE churn_predicted = c) AS said, count(*) FILTER (WHERE label = c) AS have, count(*) AS total
      FROM report, (VALUES (0), (1)) x(c) GROUP BY c),
    m AS (SELECT c, tp / said AS p, tp / have AS r, 2 * tp / (said + have) AS f, have, total FROM k)
    SELECT c::VARCHAR AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, have AS support FROM m
    UNION ALL SELECT 'accuracy', round(avg(correct::INTEGER), 6), round(avg(correct::INTEGER), 6), round(avg(correct::INTEGER), 6), count(*) FROM report
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), max(total) FROM m
    UNION ALL SELECT 'weighted avg', round(sum(p * have) / max(total), 6), round(sum(r * have) / max(total), 6), round(sum(f * have) / max(total), 6), max(total) FROM m""",
)
def report_lines(wb):
    out = evaluate.class_report(wb.report, "label", "churn_predicted")
    return out.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


_ROC = """g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1),
roc AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g
        WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    "ev_roc_curve",
    f"WITH {C360}, {SCORED}, {_ROC} SELECT score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM roc "
    "UNION ALL SELECT NULL, 0, 0",
)
def roc(wb):
    out = evaluate.roc_curve(wb.scored, "label", "score")
    shown = F.when(F.col("threshold") < float("inf"), F.col("threshold")).alias("threshold")
    return out.select(shown, F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(
    "ev_auc",
    f"""WITH {C360}, {SCORED}, {_ROC} SELECT round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 6) AS auc, max(p)::BIGINT AS positives,
    max(n)::BIGINT AS negatives FROM roc""",
)
def auc(wb):
    return evaluate.roc_auc(wb.scored, "label", "score").withColumn("auc", F.round("auc", 6))


_AUC_OF = """(SELECT sum(CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END)::DOUBLE / count(*)
 FROM s a, s b WHERE a.label = 1 AND b.label = 0 AND a.side = '{side}' AND b.side = '{side}')"""


@query(
    "ev_auc_gap",
    f"""WITH {C360}, {SPLIT}, {SCORED}, s AS (SELECT scored.*, side FROM scored JOIN split USING (CustomerID)),
    a AS (SELECT {_AUC_OF.format(side="train")} AS tr, {_AUC_OF.format(side="test")} AS te)
    SELECT round(tr, 6) AS train_auc, round(te, 6) AS test_auc, round(tr - te, 6) AS gap FROM a""",
)
def auc_gap(wb):
    sided = wb.scored.join(wb.split.select(KEY, "split"), KEY)
    gap = evaluate.auc_gap(*[sided.where(F.col("split") == s) for s in ("train", "test")], "label", "score")
    return gap.select(*[F.round(c, 6).alias(c) for c in gap.columns])


@query(
    "ev_regression",
    f"""WITH {C360}, {SPEND} SELECT count(*) AS n, round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) ^ 2)), 4) AS rmse,
    round(1 - sum((y - yhat) ^ 2) / sum((y - (SELECT avg(y) FROM spend)) ^ 2), 6) AS r2 FROM spend""",
)
def regression(wb):
    out = evaluate.regression_metrics(wb.spend, "y", "yhat")
    return out.select("n", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query(
    "ev_residuals", f"WITH {C360}, {SPEND} SELECT CustomerID, round(y - yhat, 4) AS residual FROM spend"
)
def residual_rows(wb):
    return evaluate.residuals(wb.spend, KEY, "y", "yhat").withColumn("residual", F.round("residual", 4))


@query(
    "ev_residual_hist",
    f"""WITH {C360}, {SPEND}, r AS (SELECT y - yhat AS r, min(y - yhat) OVER () AS lo, max(y - yhat) OVER () AS hi FROM spend),
    b AS (SELECT least(floor((r - lo) / ((hi - lo) / 40)), 39)::INTEGER AS bin, count(*) AS n FROM r GROUP BY 1),
    w AS (SELECT min(lo) AS lo, (max(hi) - min(lo)) / 40 AS w FROM r)
    SELECT i::INTEGER AS bin, round(lo + i * w, 4) AS lower, round(lo + (i + 1) * w, 4) AS upper, coalesce(n, 0) AS n
    FROM range(40) t(i) CROSS JOIN w LEFT JOIN b ON bin = i""",
)
def histogram(wb):
    out = evaluate.residual_histogram(wb.spend, "y", "yhat")
    return out.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


_STANDARD = ", ".join(f"({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0) AS {c}" for c in NUMERIC)
_TOTAL, _CELLS = " + ".join(f"coalesce(sum({c}), 0)" for c in NUMERIC), " + ".join(f"count({c})" for c in NUMERIC)


@query(
    "ev_scaler_means",
    f"""WITH {C360}, z AS (SELECT {_STANDARD} FROM c360)
    SELECT 'before' AS stage, round(({_TOTAL}) / ({_CELLS}), 4) AS mean FROM c360
    UNION ALL SELECT 'after', round(({_TOTAL}) / (SELECT {_CELLS} FROM c360), 4) + 0.0 FROM z""",
)
def scaler_means(wb):
    table = wb.customers.select(*NUMERIC)
    means = scaling.cell_means(table, scaling.fit_scaler(table, NUMERIC).transform(table), NUMERIC)
    return means.withColumn("mean", F.round("mean", 4) + 0.0)
