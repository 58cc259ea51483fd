"""Scalar functions and what-if features."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.functions import cleaning, risk, whatif
from basketlens.operators.encode import encode_and_clean, fit_labels
from basketlens.operators.evaluate import residual_range, with_decision
from basketlens.operators.quantiles import exact_quantiles
from basketlens.plans.prepare import clip_bounds
from basketlens.registry.base_sql import C360, CLUSTERED, SCENARIOS, SCORED, SPEND
from basketlens.registry.workbench import query
from basketlens.sources.customers import KEY


@query(
    "fn_date_parts",
    f"""WITH {C360}, d AS (SELECT CustomerID, coalesce(try_strptime(RegistrationDate, '%d/%m/%y'),
      try_strptime(RegistrationDate, '%Y-%m-%d'), try_strptime(RegistrationDate, '%d/%m/%Y'),
      try_strptime(RegistrationDate, '%m/%d/%Y'))::DATE AS day FROM c360)
    SELECT CustomerID, year(day) AS RegYear, month(day) AS RegMonth, day(day) AS RegDay, isodow(day) - 1 AS RegWeekday FROM d""",
)
def date_parts(wb):
    return cleaning.date_parts(wb.customers.select(KEY, "RegistrationDate"))


@query(
    "fn_ip_private",
    f"""WITH {C360} SELECT CustomerID,
    coalesce(try_cast(split_part(LastLoginIP, '.', 1) AS INTEGER) IN (10, 127, 172, 192), false)::INTEGER AS IP_IsPrivate,
    try_cast(split_part(LastLoginIP, '.', 1) AS INTEGER) AS first_octet FROM c360""",
)
def ip_private(wb):
    addresses = wb.customers.select(KEY, "LastLoginIP", cleaning.first_octet(F.col("LastLoginIP")).alias("first_octet"))
    return cleaning.flag_private(addresses)


@query(
    "fn_range_to_null",
    f"""WITH {C360} SELECT CustomerID, CASE WHEN SupportTicketsCount BETWEEN 0 AND 15 THEN SupportTicketsCount END AS SupportTicketsCount,
    CASE WHEN SatisfactionScore BETWEEN 1 AND 5 THEN SatisfactionScore END AS SatisfactionScore FROM c360""",
)
def range_to_null(wb):
    return cleaning.out_of_range_to_null(wb.customers.select(KEY, "SupportTicketsCount", "SatisfactionScore"))


_CLIPPED = """q AS (SELECT quantile_cont(MonetaryTotal, 0.01) AS lo, quantile_cont(MonetaryTotal, 0.99) AS hi FROM c360),
clipped AS (SELECT * REPLACE (CASE WHEN MonetaryTotal IS NOT NULL THEN least(greatest(MonetaryTotal, lo), hi) END AS MonetaryTotal)
            FROM c360, q)"""


@query("fn_winsorise", f"WITH {C360}, {_CLIPPED} SELECT CustomerID, round(MonetaryTotal, 4) AS MonetaryTotal FROM clipped")
def winsorised(wb):
    low, high = clip_bounds(wb.customers)
    return wb.customers.select(KEY, F.round(cleaning.winsorise(F.col("MonetaryTotal"), low, high), 4).alias("MonetaryTotal"))


@query(
    "fn_ratios",
    f"""WITH {C360} SELECT CustomerID, MonetaryTotal / (Frequency + 1) AS AvgBasket,
    UniqueProducts / (TotalTransactions + 1) AS DiversityRatio, CancelledTransactions / (TotalTransactions + 1) AS CancelRate,
    MonetaryTotal / (UniqueProducts + 1) AS ValuePerProduct FROM c360""",
)
def ratios(wb):
    return cleaning.add_ratios(wb.customers).select(KEY, *cleaning.RATIOS)


@query(
    "fn_fill_category",
    f"WITH {C360} SELECT coalesce(Gender, 'Inconnu') AS Gender, count(*) AS n FROM c360 GROUP BY 1",
)
def filled_category(wb):
    return wb.customers.groupBy(cleaning.category_text(F.col("Gender")).alias("Gender")).agg(F.count("*").alias("n"))


@query(
    "fn_coerce_numeric",
    f"""WITH {C360}, {SCENARIOS} SELECT CustomerID, {", ".join(
        f"try_cast(trim({c}) AS DOUBLE) AS {c}_or_null, coalesce(try_cast(trim({c}) AS DOUBLE), 0) AS {c}_or_zero" for c in whatif.DEFAULTS
    )} FROM scenarios""",
)
def coerced(wb):
    cells = [
        f(F.col(c)).alias(f"{c}_{name}")
        for c in whatif.DEFAULTS
        for f, name in ((cleaning.to_number, "or_null"), (cleaning.to_number_or_zero, "or_zero"))
    ]
    return wb.scenarios.select(KEY, *cells)


@query("fn_risk_right", f"WITH {C360}, {SCORED} SELECT CustomerID, score, risk_level FROM report")
def risk_right(wb):
    return wb.scored.select(KEY, "score", risk.risk_level(F.col("score")).alias("risk_level"))


@query(
    "fn_risk_left",
    f"""WITH {C360}, {SCORED} SELECT CustomerID, score, CASE WHEN score < 0.25 THEN 'Faible' WHEN score < 0.5 THEN 'Moyen'
    WHEN score < 0.75 THEN 'Élevé' ELSE 'Critique' END AS risk_level FROM report""",
)
def risk_left(wb):
    return wb.scored.select(KEY, "score", risk.risk_level(F.col("score"), closed="left").alias("risk_level"))


@query(
    "fn_class_decision",
    f"""WITH {C360}, {SCORED} SELECT CustomerID, (score >= 0.5)::INTEGER AS predicted, (score >= 0.5)::INTEGER = label AS correct,
    round(score * 100, 1) AS percent FROM scored""",
)
def decisions(wb):
    decided = with_decision(wb.scored, "score", "label")
    return decided.select(KEY, "predicted", "correct", F.bround(F.col("score") * 100, 1).alias("percent"))


_DEFAULTED = ", ".join(
    f"coalesce(try_cast(trim({name}) AS DOUBLE), {value}::DOUBLE) AS {name}" for name, value in whatif.DEFAULTS.items()
)
_ENTERED = f"entered AS (SELECT CustomerID, {_DEFAULTED} FROM scenarios)"


@query("fn_whatif_defaults", f"WITH {C360}, {SCENARIOS}, {_ENTERED} SELECT * FROM entered")
def entered_values(wb):
    return whatif.with_defaults(wb.scenarios)


def _whatif_sql(total: str, with_total: bool) -> str:
    shown = "MonetaryTotal, " if with_total else ""
    return f"""SELECT CustomerID, Frequency, {shown}MonetaryAvg, CustomerTenureDays, ReturnRatio, SupportTicketsCount,
    SatisfactionScore, Age, RegYear, RegMonth,
    2.0::DOUBLE AS AvgQuantityPerTransaction, 1.0::DOUBLE AS MinQuantity, 5.0::DOUBLE AS MaxQuantity, 2.0::DOUBLE AS PreferredDayOfWeek,
    14.0::DOUBLE AS PreferredHour, 0.28::DOUBLE AS WeekendPurchaseRatio, 1.5::DOUBLE AS AvgProductsPerTransaction,
    1.0::DOUBLE AS UniqueCountries, 0.0::DOUBLE AS ZeroPriceCount, 2.0::DOUBLE AS AvgLinesPerInvoice, 1.5::DOUBLE AS FavoriteSeason,
    1.0::DOUBLE AS PreferredTimeOfDay, 0.0::DOUBLE AS Region, 0.0::DOUBLE AS WeekendPreference, 0.0::DOUBLE AS Gender,
    0.0::DOUBLE AS Country, 15.0::DOUBLE AS RegDay, 2.0::DOUBLE AS RegWeekday, 1.0::DOUBLE AS IP_IsPrivate,
    MonetaryAvg * 0.3 AS MonetaryStd, MonetaryAvg * 3 AS MonetaryMax, Frequency * 2 AS TotalQuantity,
    Frequency AS TotalTransactions, Frequency AS UniqueInvoices, RegMonth AS PreferredMonth,
    greatest(MonetaryAvg * 0.2, 1) AS MonetaryMin, greatest(Frequency * 1.5, 1) AS UniqueProducts,
    greatest(Frequency * 1.6, 1) AS UniqueDescriptions,
    CASE WHEN Age < 30 THEN 0.0::DOUBLE WHEN Age < 50 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS AgeCategory,
    CASE WHEN {total} < 300 THEN 0.0::DOUBLE WHEN {total} < 1000 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS SpendingCategory,
    CASE WHEN MonetaryAvg < 50 THEN 0.0::DOUBLE WHEN MonetaryAvg < 200 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS BasketSizeCategory,
    CustomerTenureDays + 30 AS FirstPurchaseDaysAgo, CustomerTenureDays / greatest(Frequency, 1) AS AvgDaysBetweenPurchases,
    ReturnRatio * Frequency AS NegativeQuantityCount, ReturnRatio * Frequency * 0.5 AS CancelledTransactions,
    greatest(Frequency * 1.5, 1) / greatest(Frequency * 2, 1) AS ProductDiversity, {total} / greatest(Frequency, 1) AS AvgBasket,
    greatest(Frequency * 1.5, 1) / greatest(Frequency + 1, 1) AS DiversityRatio,
    ReturnRatio * Frequency * 0.5 / greatest(Frequency + 1, 1) AS CancelRate,
    {total} / greatest(greatest(Frequency * 1.5, 1) + 1, 1) AS ValuePerProduct FROM entered"""


def _all_rounded(inner: str, digits: int = 6) -> str:
    return f"SELECT CustomerID, round(COLUMNS(* EXCLUDE (CustomerID))::DOUBLE, {digits}) FROM ({inner})"


@query("fn_whatif_vector", f"WITH {C360}, {SCENARIOS}, {_ENTERED} {_all_rounded(_whatif_sql('MonetaryTotal', True))}")
def whatif_vector(wb):
    filled = whatif.with_defaults(wb.scenarios)
    derived = whatif.derived_features()
    return filled.select(KEY, *[F.round(e.cast("double"), 6).alias(n) for n, e in derived.items()])


@query(
    "fn_whatif_regressor",
    f"WITH {C360}, {SCENARIOS}, {_ENTERED} {_all_rounded(_whatif_sql('(MonetaryAvg * Frequency)', False))}",
)
def whatif_regressor(wb):
    filled = whatif.with_defaults(wb.scenarios)
    derived = whatif.derived_features(spend="average")
    return filled.select(KEY, *[F.round(e.cast("double"), 6).alias(n) for n, e in derived.items()])


@query(
    "fn_whatif_resolve",
    f"""WITH {C360}, {SCENARIOS}, {_ENTERED} SELECT CustomerID, greatest(Frequency * 1.5, 1)::DOUBLE AS UniqueProducts,
    (SELECT quantile_cont(AccountBalance, 0.5) FROM c360)::DOUBLE AS AccountBalance, 0.0::DOUBLE AS OrderPriority, Age FROM entered""",
)
def whatif_resolved(wb):
    medians = {"AccountBalance": exact_quantiles(wb.customers, ["AccountBalance"], [0.5])["AccountBalance"][0.5]}
    filled = whatif.with_defaults(wb.scenarios)
    features = ["UniqueProducts", "AccountBalance", "OrderPriority", "Age"]
    return whatif.resolve_features(filled, features, whatif.derived_features(), medians, keep=(KEY,))


@query(
    "fn_category_codes",
    f"""WITH {C360} SELECT CustomerID, CASE WHEN coalesce(Age, 35) < 30 THEN 0.0::DOUBLE WHEN coalesce(Age, 35) < 50 THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE END AS AgeCategory, CASE WHEN TotalQuantity < 300 THEN 0.0::DOUBLE WHEN TotalQuantity < 1000 THEN 1.0::DOUBLE
    ELSE 2.0::DOUBLE END AS SpendingCategory FROM c360""",
)
def category_codes(wb):
    return wb.customers.select(
        KEY,
        whatif.category_code(F.coalesce("Age", F.lit(35.0)), "AgeCategory").alias("AgeCategory"),
        whatif.category_code(F.col("TotalQuantity"), "SpendingCategory").alias("SpendingCategory"),
    )


@query(
    "fn_closeness",
    f"""WITH {C360}, {CLUSTERED} SELECT CustomerID, cluster,
    {", ".join(f"round((list_max(distances) - distances[{i}]) / (CASE WHEN list_max(distances) <> list_min(distances) THEN list_max(distances) - list_min(distances) ELSE 1 END) * 100, 1) AS closeness_{i - 1}" for i in (1, 2, 3))}
    FROM clustered""",
)
def closeness(wb):
    shown = wb.clustered.withColumn("closeness", risk.closeness(F.col("distances")))
    return shown.select(KEY, "cluster", *[F.col("closeness")[i].alias(f"closeness_{i}") for i in range(3)])


@query(
    "fn_spend_delta",
    f"WITH {C360}, {SPEND} SELECT CustomerID, round(yhat - y, 4) AS delta FROM spend",
)
def spend_delta(wb):
    return wb.spend.select(KEY, F.round(risk.spend_delta(F.col("yhat"), F.col("y")), 4).alias("delta"))


@query(
    "fn_recommendations",
    f"""WITH {C360}, {SCORED}, {CLUSTERED}, t AS (
      SELECT c.CustomerID, risk_level AS l, CASE WHEN c.CustomerID % 4 <> 0 THEN TotalQuantity * 2100.0::DOUBLE END AS p, MonetaryTotal AS e, cluster
      FROM clustered c JOIN report r USING (CustomerID))
    SELECT CustomerID, concat_ws(',',
      CASE WHEN l IN ('Élevé', 'Critique') THEN 'retention_campaign,exclusive_discount,support_contact,analyse_dissatisfaction' END,
      CASE WHEN l IN ('Élevé', 'Critique') AND p > e THEN 'high_potential_retention' END,
      CASE WHEN l = 'Moyen' THEN 'reengagement_email,loyalty_programme,watch_purchases' END,
      CASE WHEN l = 'Faible' THEN 'newsletter_recommendations,vip_programme,referral_and_reviews' END,
      CASE WHEN l = 'Faible' AND p IS NOT NULL THEN 'premium_products' END,
      CASE WHEN l IS NOT NULL THEN 'adapt_to_segment_' || cluster END) AS actions FROM t""",
)
def recommended(wb):
    customers = wb.customers.select(KEY, "TotalQuantity", F.col("MonetaryTotal").alias("entered"))
    joined = wb.report.select(KEY, "risk_level").join(wb.clustered.select(KEY, "cluster"), KEY).join(customers, KEY)
    predicted = F.when(F.col(KEY) % 4 != 0, F.col("TotalQuantity") * 2100.0)
    actions = risk.recommendations(F.col("risk_level"), predicted, F.col("entered"), F.col("cluster"))
    return joined.select(KEY, F.concat_ws(",", actions).alias("actions"))


@query(
    "fn_residual_range",
    f"WITH {C360}, {SPEND} SELECT round(greatest(max(abs(y)), max(abs(yhat))), 4) AS \"limit\" FROM spend",
)
def plot_range(wb):
    return residual_range(wb.spend, "y", "yhat").withColumn("limit", F.round("limit", 4))


@query(
    "fn_encode_and_clean",
    f"""WITH {C360}, {SCENARIOS}, codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT Country AS v FROM c360))
    SELECT s.CustomerID, code::DOUBLE AS Country, {", ".join(f"coalesce(try_cast(trim(s.{c}) AS DOUBLE), 0) AS {c}" for c in whatif.DEFAULTS)}
    FROM scenarios s JOIN c360 USING (CustomerID) JOIN codes ON v = Country""",
)
def cleaned_numbers(wb):
    mapping = fit_labels(wb.customers, ["Country"])
    batch = wb.scenarios_with("Country")
    return encode_and_clean(batch, mapping, ["Country"], keep=(KEY,))
