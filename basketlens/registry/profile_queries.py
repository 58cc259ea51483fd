"""Sources, sinks, profiling and column selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.operators import correlation, profile, select
from basketlens.operators.clustering import cluster_profiles
from basketlens.operators.quantiles import exact_quantiles
from basketlens.plans.report import high_risk_share
from basketlens.registry.base_sql import C360, CLUSTERED, SCORED, SPLIT
from basketlens.registry.workbench import DOUBLES, EVERY, INTS, LONGS, NUMERIC, TEXTS, query
from basketlens.sources.customers import (
    header_columns,
    KEY,
    SHORT_TO_LONG,
    TARGET,
    canonical_names,
    load_split,
    read_customers_csv,
    write_split,
    write_table,
)

NUMBERS, PROFILED = NUMERIC, EVERY

_LONG_ROWS = ", ".join(f"'{c}'" for c in NUMBERS)


def _unpivot(columns: list[str], expression: str) -> str:
    """One SELECT per column, ``{c}`` standing for its name."""
    return "\nUNION ALL ".join(expression.format(c=c) for c in columns)


@query(
    "src_customer360",
    f"""WITH {C360} SELECT CustomerID, Churn, Recency, Frequency, MonetaryTotal,
    round(MonetaryStd, 4) AS MonetaryStd, TotalQuantity, UniqueProducts, UniqueDescriptions, UniqueCountries,
    PreferredDayOfWeek, PreferredMonth, PreferredHour, OrderPriority, AvgProductsPerTransaction,
    ReturnRatio, Country, Region, RegistrationDate, LastLoginIP FROM c360""",
)
def customer_table(wb):
    columns = (
        "CustomerID Churn Recency Frequency MonetaryTotal MonetaryStd TotalQuantity UniqueProducts UniqueDescriptions "
        "UniqueCountries PreferredDayOfWeek PreferredMonth PreferredHour OrderPriority AvgProductsPerTransaction "
        "ReturnRatio Country Region RegistrationDate LastLoginIP"
    ).split()
    return wb.customers.select(*columns).withColumn("MonetaryStd", F.round("MonetaryStd", 4))


@query(
    "src_canonical_names",
    f"""WITH {C360} SELECT CustomerID, CustomerTenureDays, UniqueDescriptions, TotalTransactions, CancelledTransactions,
    SupportTicketsCount, SatisfactionScore FROM c360""",
)
def short_dialect(wb):
    long = [KEY, "CustomerTenureDays", "UniqueDescriptions", "TotalTransactions", "CancelledTransactions",
            "SupportTicketsCount", "SatisfactionScore"]
    to_short = {v: k for k, v in SHORT_TO_LONG.items() if v in long}
    return canonical_names(wb.customers.select(*long).withColumnsRenamed(to_short))


@query(
    "src_load_and_inspect",
    f"""WITH {C360}, t AS (SELECT {", ".join(PROFILED)} FROM c360),
    m AS ({_unpivot(PROFILED, "SELECT '{c}' AS name, count(*) - count({c}) AS n FROM t")})
    SELECT 'shape' AS section, 'rows' AS name, count(*)::DOUBLE AS value FROM t
    UNION ALL SELECT 'shape', 'columns', {len(PROFILED)}.0::DOUBLE
    UNION ALL SELECT 'types', t, n::DOUBLE FROM (VALUES ('bigint', {len(LONGS)}), ('int', {len(INTS)}), ('double', {len(DOUBLES)}), ('string', {len(TEXTS)})) v(t, n)
    UNION ALL SELECT 'missing', name, n::DOUBLE FROM (SELECT * FROM m WHERE n > 0 ORDER BY n DESC, name LIMIT 10)
    UNION ALL SELECT 'duplicates', 'rows', (SELECT count(*) FROM t)::DOUBLE - (SELECT count(*) FROM (SELECT DISTINCT * FROM t))""",
)
def load_and_inspect(wb):
    return profile.load_and_inspect(wb.customers.select(*PROFILED))


#: Whole numbers and texts are compared as they are, other numbers to six places.
_SHOWN = [*LONGS, *INTS, *TEXTS]
_ROUNDED = ", ".join([*_SHOWN, *[f"round({c}, 6) + 0.0 AS {c}" for c in DOUBLES]])


@query("src_customers_csv", f"WITH {C360} SELECT {_ROUNDED} FROM c360")
def customers_csv(wb):
    """The whole customer table through a CSV file and back."""
    read = read_customers_csv(wb.spark, write_table(wb.customers.select(*EVERY), wb.path("customers_csv"), "csv"))
    return read.select(*_SHOWN, *[(F.round(c, 6) + 0.0).alias(c) for c in DOUBLES])


@query(
    "src_header_columns",
    "SELECT place::INTEGER AS place, name FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(EVERY)) + ") v(place, name)",
)
def header_order(wb):
    """Column order from the header line of the written table."""
    names = header_columns(wb.spark, write_table(wb.customers.select(*EVERY), wb.path("customers_csv"), "csv"))
    return wb.spark.createDataFrame(list(enumerate(names)), "place int, name string")


_KINDS = "SELECT '{c}' AS name, typeof(any_value({c})) IN ('BIGINT', 'INTEGER', 'DOUBLE') AS numeric, typeof(any_value({c})) = 'VARCHAR' AS text FROM c360"


@query("sel_column_kinds", f"WITH {C360} {_unpivot(EVERY, _KINDS)}")
def column_kinds(wb):
    """Which columns are numbers and which are text, from the schema alone."""
    df = wb.customers.select(*EVERY)
    numbers, texts = select.numeric_columns(df), select.text_columns(df)
    return wb.spark.createDataFrame([(c, c in numbers, c in texts) for c in df.columns], "name string, numeric boolean, text boolean")


@query("src_load_split", f"WITH {C360}, {SPLIT} SELECT {_ROUNDED} FROM split WHERE side = 'train'")
def train_side(wb):
    sides = [wb.split.where(F.col("split") == s).drop("split") for s in ("train", "test")]
    path = write_split(*sides, wb.path("split"))
    return load_split(wb.spark, path, "train").select(*_SHOWN, *[(F.round(c, 6) + 0.0).alias(c) for c in DOUBLES])


@query(
    "snk_split_tables",
    f"WITH {C360}, {SPLIT} SELECT side AS split, {_ROUNDED} FROM split",
)
def split_tables(wb):
    sides = [wb.split.where(F.col("split") == s).drop("split") for s in ("train", "test")]
    written = wb.spark.read.parquet(write_split(*sides, wb.path("split")))
    return written.select("split", *_SHOWN, *[(F.round(c, 6) + 0.0).alias(c) for c in DOUBLES])


@query(
    "snk_reports",
    f"WITH {C360}, {SCORED} SELECT CustomerID, churn_predicted, score, risk_level, label, correct FROM report",
)
def churn_report(wb):
    path = write_table(wb.report, wb.path("churn_report"), "csv")
    read = wb.spark.read.schema(wb.report.schema).option("header", True).csv(path)
    return read.select(KEY, "churn_predicted", "score", "risk_level", "label", "correct")


@query(
    "snk_cluster_profiles",
    f"WITH {C360}, {CLUSTERED} SELECT cluster, {', '.join(f'round(avg({c}), 3) AS {c}' for c in NUMERIC)} FROM clustered GROUP BY 1",
)
def profiles_sink(wb):
    profiles = cluster_profiles(wb.clustered, NUMERIC)
    return wb.spark.read.parquet(write_table(profiles, wb.path("profiles")))


@query("pro_shape", f"WITH {C360} SELECT count(*) AS rows, 43 AS columns FROM c360")
def table_shape(wb):
    return profile.shape(wb.customers)


@query(
    "pro_missing_top10",
    f"""WITH {C360}, m AS ({_unpivot(PROFILED, "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(*) AS total FROM c360")})
    SELECT "column", missing, round(missing / total, 6) AS share FROM m WHERE missing > 0 ORDER BY missing DESC, "column" LIMIT 10""",
)
def missing_top10(wb):
    return profile.top_missing(wb.customers.select(*PROFILED)).withColumn("share", F.round("share", 6))


@query(
    "pro_duplicates",
    "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicates FROM lineitem",
)
def duplicates(wb):
    return profile.duplicate_rows(wb.table("lineitem"))


@query(
    "pro_summary",
    f"""WITH {C360} {_unpivot(NUMBERS, '''SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
    round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
    round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75,
    round(max({c})::DOUBLE, 4) AS max FROM c360''')}""",
)
def table_summary(wb):
    out = profile.summary(wb.customers, NUMBERS)
    return out.select("column", "count", *[F.round(c, 4).alias(c) for c in out.columns[2:]])


@query("pro_head", f"WITH {C360} SELECT CustomerID, Churn, Frequency, Country FROM c360 ORDER BY CustomerID LIMIT 5")
def first_rows(wb):
    return profile.head(wb.customers.select(KEY, TARGET, "Frequency", "Country"), KEY)


_PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[:i]]
_CORR = (
    "SELECT unnest(["
    + ", ".join(f"{{'feature_1': '{a}', 'feature_2': '{b}', 'correlation': round(corr({a}, {b}), 6)}}" for a, b in _PAIRS)
    + "], recursive := true) FROM c360"
)


@query("pro_corr_matrix", f"WITH {C360} {_CORR}")
def correlation_long(wb):
    return correlation.correlation_pairs(wb.customers, NUMBERS).withColumn("correlation", F.round("correlation", 6))


@query(
    "pro_high_corr_pairs",
    f"""WITH {C360}, r AS ({_CORR}) SELECT feature_2 AS feature_1, feature_1 AS feature_2, round(abs(correlation), 4) AS correlation
    FROM r WHERE abs(correlation) >= 0.8 AND NOT isnan(correlation)""",
)
def strong_pairs(wb):
    return correlation.high_correlation_pairs(wb.customers, 0.8, NUMBERS)


@query(
    "pro_class_distribution",
    f"WITH {C360} SELECT Churn AS class, count(*) AS n, round(count(*) / (SELECT count(*) FROM c360), 6) AS share FROM c360 GROUP BY 1",
)
def classes(wb):
    return profile.class_distribution(wb.customers).withColumn("share", F.round("share", 6))


@query(
    "pro_target_rates",
    f"""WITH {C360}, {SPLIT} SELECT side AS split, count(*) AS n, sum(Churn)::BIGINT AS positives, round(avg(Churn), 6) AS rate
    FROM split GROUP BY 1""",
)
def target_rates(wb):
    return profile.target_rates(wb.split).withColumn("rate", F.round("rate", 6))


@query(
    "pro_outlier_counts",
    f"""WITH {C360}, q AS (SELECT quantile_cont(MonetaryTotal, 0.01) AS lo, quantile_cont(MonetaryTotal, 0.99) AS hi FROM c360)
    SELECT 'SupportTicketsCount outside [0, 15]' AS rule, count(*) FILTER (WHERE SupportTicketsCount NOT BETWEEN 0 AND 15) AS n FROM c360
    UNION ALL SELECT 'SatisfactionScore outside [1, 5]', count(*) FILTER (WHERE coalesce(SatisfactionScore NOT BETWEEN 1 AND 5, true)) FROM c360
    UNION ALL SELECT 'MonetaryTotal clipped', count(*) FILTER (WHERE MonetaryTotal NOT BETWEEN lo AND hi) FROM c360, q""",
)
def outliers(wb):
    bounds = exact_quantiles(wb.customers, ["MonetaryTotal"], [0.01, 0.99])["MonetaryTotal"]
    return profile.outlier_counts(wb.customers, bounds)


@query(
    "sel_constant_columns",
    f"""WITH {C360} {_unpivot([c for c in PROFILED if c != TARGET],
    "SELECT '{c}' AS \"column\", count(DISTINCT {c}) + (CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END) <= 1 AS is_constant FROM c360")}""",
)
def constants(wb):
    return select.constant_profile(wb.customers.select(*PROFILED))


@query(
    "sel_missing_columns",
    f"""WITH {C360}, m AS ({_unpivot(PROFILED, "SELECT '{c}' AS \"column\", 1 - count({c}) / count(*) AS share FROM c360")})
    SELECT "column", round(share, 6) AS share, share > 0.5 AS dropped FROM m""",
)
def missing_columns(wb):
    shares = select.missing_profile(wb.customers.select(*PROFILED))
    return shares.select("column", F.round("share", 6).alias("share"), (F.col("share") > 0.5).alias("dropped"))


@query(
    "sel_drop_useless",
    f"""WITH {C360} SELECT Churn, Frequency, Gender, MonetaryTotal, LastLoginIP FROM c360""",
)
def model_inputs(wb):
    table = wb.customers.select(KEY, TARGET, "Recency", "CustomerType", "Frequency", "Gender", "MonetaryTotal", "PreferredHour",
                                "ZeroPriceCount", "NewsletterSubscribed", "LastLoginIP")
    useful = select.drop_useless(table, select.constant_columns(table))
    return useful.drop(*select.high_missing_columns(useful))


@query("sel_align", f"WITH {C360} SELECT CustomerID, 0.0::DOUBLE AS RegYear, TotalQuantity, Frequency FROM c360")
def aligned(wb):
    return select.align(wb.customers, ["RegYear", "TotalQuantity", "Frequency"], keep=(KEY,))


@query(
    "sel_pad_or_truncate",
    """SELECT vec_id, round(list_sum(embedding[1:10]::DOUBLE[]), 9) AS first10,
    len(embedding[1:10])::INTEGER AS n_cut, 70 AS n_padded, embedding[64]::DOUBLE AS last_real, 0.0::DOUBLE AS pad FROM embeddings""",
)
def padded(wb):
    x = F.col("embedding").cast("array<double>")
    short, long = select.pad_or_truncate(x, 10), select.pad_or_truncate(x, 70)
    return wb.table("embeddings").select(
        "vec_id",
        F.round(F.aggregate(short, F.lit(0.0), lambda a, v: a + v), 9).alias("first10"),
        F.size(short).alias("n_cut"),
        F.size(long).alias("n_padded"),
        long[63].alias("last_real"),
        long[69].alias("pad"),
    )


@query(
    "sel_regression_inputs",
    f"WITH {C360} SELECT CustomerID, Frequency, MonetaryAvg, TotalQuantity FROM c360",
)
def spend_inputs(wb):
    return select.regression_inputs(wb.customers.select(KEY, TARGET, "Frequency", "MonetaryTotal", "MonetaryAvg", "TotalQuantity"))


@query("sel_keep_features", f"WITH {C360} SELECT CustomerID, TotalQuantity, UniqueProducts, Frequency FROM c360")
def kept_features(wb):
    features = select.guard_features(["TotalQuantity", "UniqueProducts", "Recency", "Frequency", "CustomerType"])
    return wb.customers.select(KEY, *features)


@query(
    "sel_high_risk",
    f"""WITH {C360}, {SCORED} SELECT count(*) FILTER (WHERE risk_level IN ('Élevé', 'Critique')) AS high_risk,
    round(count(*) FILTER (WHERE risk_level IN ('Élevé', 'Critique')) / count(*), 6) AS share FROM report""",
)
def high_risk(wb):
    return high_risk_share(wb.report).withColumn("share", F.round("share", 6))
