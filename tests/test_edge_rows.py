"""Hand-made rows for every trap of the cleaning, encoding and evaluation semantics."""

import math

import pytest
from pyspark.sql import functions as F

from basketlens.functions import cleaning, risk, whatif
from basketlens.operators import clustering, encode, evaluate, profile, scaling, select
from basketlens.sources import customers


def values(df, column):
    return [r[column] for r in df.collect()]


def test_dates(spark):
    cases = {
        "15/03/21": (2021, 3, 15, 0),
        "2021-03-16": (2021, 3, 16, 1),
        "03/04/2021": (2021, 4, 3, 5),  # day first wins
        "12/25/2020": (2020, 12, 25, 4),  # only month first fits
        "01/02/95": (1995, 2, 1, 2),
        "31/02/2021": (None,) * 4,
        "soon": (None,) * 4,
        "": (None,) * 4,
        None: (None,) * 4,
    }
    df = spark.createDataFrame([(t,) for t in cases], "RegistrationDate string")
    rows = cleaning.date_parts(df).collect()
    assert [tuple(r) for r in rows] == list(cases.values())
    assert "RegistrationDate" not in rows[0].asDict()


def test_private_addresses(spark):
    cases = {"10.1.1.1": (1, 1), "127.0.0.1": (1, 1), "172.99.0.1": (1, 0), "172.16.0.9": (1, 1), "192.168.1.1": (1, 1),
             "192.0.2.1": (1, 0), "8.8.8.8": (0, 0), "abc": (0, 0), "": (0, 0), None: (0, 0)}
    df = spark.createDataFrame([(a,) for a in cases], "ip string")
    rows = df.select(cleaning.is_private(F.col("ip")).alias("a"), cleaning.is_private(F.col("ip"), True).alias("b")).collect()
    assert [tuple(r) for r in rows] == list(cases.values())


def test_ranges(spark):
    df = spark.createDataFrame(
        [(-1.0, 0.9), (0.0, 1.0), (15.0, 5.0), (16.0, 5.1), (999.0, 99.0), (None, None)],
        "SupportTicketsCount double, SatisfactionScore double",
    )
    out = cleaning.out_of_range_to_null(df)
    assert values(out, "SupportTicketsCount") == [None, 0.0, 15.0, None, None, None]
    assert values(out, "SatisfactionScore") == [None, 1.0, 5.0, None, None, None]


def test_winsorise_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (1.0,), (5.0,), (9.0,)], "v double")
    assert values(df.select(cleaning.winsorise(F.col("v"), 2, 8).alias("v")), "v") == [None, 2.0, 5.0, 8.0]


def test_ratios_survive_a_zero_divisor(spark):
    df = spark.createDataFrame([(10.0, -1), (10.0, 4)], "MonetaryTotal double, Frequency int")
    assert values(cleaning.add_ratios(df), "AvgBasket") == [None, 2.0]
    assert cleaning.add_ratios(df).columns == ["MonetaryTotal", "Frequency", "AvgBasket"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int")
    assert values(customers.nan_to_null(df), "a") == [None, 2.0]


def test_numbers_from_text(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("x",), ("",), (None,), ("NaN",), ("1e3",)], "t string")
    assert values(df.select(cleaning.to_number(F.col("t")).alias("v")), "v") == [1.5, None, None, None, None, 1000.0]
    assert values(df.select(cleaning.to_number_or_zero(F.col("t")).alias("v")), "v") == [1.5, 0, 0, 0, 0, 1000.0]


def test_risk_bins_differ_at_the_bounds(spark):
    points = [0.0, 0.1, 0.25, 0.26, 0.5, 0.75, 0.76, 1.0, None]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    right = values(df.select(risk.risk_level(F.col("p")).alias("l")), "l")
    left = values(df.select(risk.risk_level(F.col("p"), "left").alias("l")), "l")
    assert right == [None, "Faible", "Faible", "Moyen", "Moyen", "Élevé", "Critique", "Critique", None]
    assert left == ["Faible", "Faible", "Moyen", "Moyen", "Élevé", "Critique", "Critique", "Critique", None]
    with pytest.raises(ValueError):
        risk.risk_level(F.col("p"), "both")


def test_closeness_and_equal_distances(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0],), ([2.0, 2.0],)], "d array<double>")
    assert values(df.select(risk.closeness(F.col("d")).alias("c")), "c") == [[100.0, 0.0, 50.0], [0.0, 0.0]]
    assert values(df.select(clustering.nearest_centre(F.col("d")).alias("c")), "c") == [0, 0]


def test_recommendations(spark):
    df = spark.createDataFrame(
        [("Critique", 10.0, 5.0, 1), ("Élevé", 4.0, 5.0, None), ("Moyen", 9.0, 1.0, 0), ("Faible", None, 5.0, None), (None, 1.0, 1.0, 1)],
        "l string, p double, e double, s int",
    )
    got = values(df.select(risk.recommendations(*[F.col(c) for c in "lpes"]).alias("a")), "a")
    assert got[0] == [*risk.URGENT_ACTIONS, risk.URGENT_UPLIFT_ACTION, "adapt_to_segment_1"]
    assert got[1] == list(risk.URGENT_ACTIONS)
    assert got[2] == [*risk.MODERATE_ACTIONS, "adapt_to_segment_0"]
    assert got[3] == list(risk.LOYAL_ACTIONS)
    assert got[4] == []


def test_what_if_defaults_and_features(spark):
    df = spark.createDataFrame([("", "abc", None, "0"), ("4", " 900 ", "60", "730")], "Frequency string, MonetaryTotal string, MonetaryAvg string, CustomerTenureDays string")
    filled = whatif.with_defaults(df)
    derived = whatif.derived_features()
    rows = filled.select(*[e.alias(n) for n, e in derived.items()]).collect()
    assert len(derived) == 50
    assert (rows[0]["Frequency"], rows[0]["MonetaryTotal"], rows[0]["MonetaryAvg"], rows[0]["Age"]) == (5.0, 500.0, 100.0, 35.0)
    assert rows[0]["AvgDaysBetweenPurchases"] == 0.0
    second = rows[1]
    assert (second["MonetaryStd"], second["MonetaryMin"], second["MonetaryMax"]) == pytest.approx((18.0, 12.0, 180.0))
    assert (second["AvgBasket"], second["ValuePerProduct"]) == pytest.approx((225.0, 900 / 7))
    assert (second["SpendingCategory"], second["BasketSizeCategory"], second["AgeCategory"]) == (1.0, 1.0, 1.0)
    spend = whatif.derived_features("average")
    assert "MonetaryTotal" not in spend and len(spend) == 49
    assert filled.select(spend["AvgBasket"].alias("v")).collect()[1]["v"] == pytest.approx(60.0)
    shared = whatif.derived_features(shared_basket=True)
    assert filled.select(shared["AvgBasket"].alias("v")).collect()[1]["v"] == pytest.approx(180.0)


def test_resolution_order(spark):
    df = whatif.with_defaults(spark.createDataFrame([(1,)], "k int"))
    out = whatif.resolve_features(df, ["Age", "Extra", "Else"], whatif.derived_features(), {"Age": 1.0, "Extra": 7.5}, ("k",))
    assert tuple(out.first()) == (1, 35.0, 7.5, 0.0)


def test_constant_and_missing_columns(spark):
    rows = [(1, "a", None, 1.0, float("nan"), None if i < 2 else "x", i) for i in range(4)]
    df = spark.createDataFrame(rows, "one int, same string, none string, num double, nans double, half string, Churn int")
    assert set(select.constant_columns(df)) == {"one", "same", "none", "num", "nans"}
    assert select.constant_columns(spark.createDataFrame([(1, None), (1, 2)], "a int, b int")) == ["a"]
    assert set(select.high_missing_columns(df)) == {"none", "nans"}  # exactly half stays


def test_guard_and_alignment(spark):
    with pytest.raises(ValueError):
        select.guard_features(["Age", "Churn"])
    assert select.guard_features(["Age", "Recency", "ChurnRisk"]) == ["Age"]
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k int, b double, x double")
    out = select.align(df, ["a", "b"], ("k",))
    assert out.columns == ["k", "a", "b"] and tuple(out.first()) == (1, 0.0, 2.0)
    assert select.numeric_columns(df) == ["k", "b", "x"] and select.text_columns(df) == []
    padded = df.select(select.pad_or_truncate(F.array("b", "x"), 3).alias("l"), select.pad_or_truncate(F.array("b", "x"), 1).alias("s")).first()
    assert padded["l"] == [2.0, 3.0, 0.0] and padded["s"] == [2.0]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "n int, t string")
    assert profile.duplicate_rows(df).first()["duplicates"] == 3
    assert {tuple(r) for r in profile.type_counts(df).collect()} == {("int", 1), ("string", 1)}
    top = profile.top_missing(df).collect()
    assert [(r["column"], r["missing"], r["share"]) for r in top] == [("t", 2, 0.4)]


def test_labels_sort_by_code_point(spark):
    train = spark.createDataFrame([("z",), ("Été",), ("a",), ("B",), (None,)], "c string")
    test = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    _, coded, mapping = encode.encode_pair(train, test)
    order = [r["value"] for r in mapping.orderBy("code").collect()]
    assert order == ["B", "Inconnu", "a", "z", "Été"]
    assert values(coded, "c") == [2, 0, 1]


def test_text_that_is_a_number_after_encoding(spark):
    mapping = encode.fit_labels(spark.createDataFrame([("x",), ("y",)], "c string"), ["c"])
    batch = spark.createDataFrame([(1, "y", "3"), (2, "?", "bad")], "k int, c string, n string")
    out = encode.encode_and_clean(batch, mapping, ["c"], keep=("k",)).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, 1.0, 3.0), (2, 0.0, 0.0)]


def test_imputation_only_where_something_is_missing(spark):
    train = spark.createDataFrame([(1.0, 1.0, None), (2.0, float("nan"), None), (4.0, 10.0, None)], "a double, b double, c double")
    test = spark.createDataFrame([(None, 1.0, 5.0)], "a double, b double, c double")
    medians = scaling.train_medians(train, ["a", "b", "c"], test)
    assert medians == {"a": 2.0, "b": 5.5}
    assert tuple(scaling.impute(test, medians).first())[:2] == (2.0, 1.0)
    assert values(scaling.impute(train, medians), "b") == [1.0, 5.5, 10.0]


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    scaler = scaling.fit_scaler(df, ["a", "b"])
    assert scaler.deviations == (1.0, 0.0)
    assert [tuple(r) for r in scaler.transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_known_confusion_figures(spark):
    """578 / 6 / 3 / 288 gives the published accuracy and predicted rate."""
    cells = {(0, 0): 578, (0, 1): 6, (1, 0): 3, (1, 1): 288}
    df = spark.createDataFrame([(a, p) for (a, p), n in cells.items() for _ in range(n)], "a int, p int")
    assert evaluate.accuracy(df, "a", "p").first()["accuracy"] == pytest.approx(0.989714, abs=5e-7)
    matrix = {(r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion_matrix(df, "a", "p").collect()}
    assert matrix == cells
    report = {r["class"]: r for r in evaluate.class_report(df, "a", "p").collect()}
    assert report["1"]["precision"] == pytest.approx(288 / 294)
    assert report["1"]["recall"] == pytest.approx(288 / 291)
    assert report["weighted avg"]["recall"] == pytest.approx(report["accuracy"]["f1"])
    assert df.agg(F.avg("p")).first()[0] == pytest.approx(0.336)


def test_report_of_an_absent_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "a int, p int")
    line = {r["class"]: r for r in evaluate.class_report(df, "a", "p").collect()}["1"]
    assert (line["precision"], line["recall"], line["f1"], line["support"]) == (0.0, 0.0, 0.0, 0)


def test_auc_with_ties_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "y int, s double")
    assert evaluate.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(0.625)
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "y", "s").collect()}
    assert points == {math.inf: (0.0, 0.0), 0.9: (0.5, 0.5), 0.4: (0.5, 1.0), 0.1: (1.0, 1.0)}
    assert evaluate.roc_auc(df.where("y = 1"), "y", "s").first()["auc"] is None


def test_regression_and_histogram(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    m = evaluate.regression_metrics(df, "y", "p").first()
    assert (m["mae"], m["rmse"], m["r2"]) == pytest.approx((1.0, math.sqrt(5 / 3), 1 - 5 / 2))
    bins = evaluate.residual_histogram(df, "y", "p").orderBy("bin").collect()
    assert len(bins) == 40 and sum(b["n"] for b in bins) == 3 and bins[39]["n"] == 1
    same = evaluate.residual_histogram(df.select("y", F.col("y").alias("p")), "y", "p").collect()
    assert sum(b["n"] for b in same) == 3
    assert evaluate.residual_range(df, "y", "p").first()["limit"] == 5.0


def test_csv_in_the_short_dialect(spark, tmp_path):
    path = str(tmp_path / "customers")
    spark.createDataFrame(
        [(1, "5", "", "-1", "Yes", "15/03/21"), (2, "7", "NaN", "3", None, "x")],
        "CustomerID long, Frequency string, Age string, SupportTickets string, NewsletterSubscribed string, RegistrationDate string",
    ).coalesce(1).write.option("header", True).csv(path)
    assert customers.header_columns(spark, path)[3] == "SupportTickets"
    df = customers.read_customers_csv(spark, path)
    assert "SupportTicketsCount" in df.columns
    assert dict(df.dtypes)["Frequency"] == "bigint" and dict(df.dtypes)["SupportTicketsCount"] == "double"
    assert values(df.orderBy("CustomerID"), "Age") == [None, None]
    assert customers.resolve_column(df, ["Monetary", "Frequency"]) == "Frequency"
    assert customers.resolve_column(df, ["x"]) is None
    both = spark.createDataFrame([(1.0, 2.0)], "SupportTickets double, SupportTicketsCount double")
    assert customers.canonical_names(both).columns == both.columns
