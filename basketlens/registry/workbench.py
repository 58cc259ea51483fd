"""Derived tables and models the registered queries share.

The customer table is derived from the given tables and written once per session
and state of the input files; models are fitted on it when first asked for.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.functions.risk import decide, risk_level
from basketlens.operators.clustering import assign
from basketlens.operators.split import stratified_split
from basketlens.plans.prepare import Prepared, prepare
from basketlens.plans.train import Training, TrainingSizes
from basketlens.sources.artefacts import Bundle, bundle_of
from basketlens.sources.customer360 import customer360, table
from basketlens.sources.customers import KEY, TARGET
from basketlens.staging import new_path, small_tasks, stage

#: Columns of the customer table with the profile fixture, by type.
LONGS = ("CustomerID Frequency UniqueInvoices UniqueProducts UniqueDescriptions UniqueCountries TotalTransactions "
         "NegativeQuantityCount CancelledTransactions ZeroPriceCount").split()  # fmt: skip
INTS = "Churn Recency CustomerTenureDays FirstPurchaseDaysAgo PreferredDayOfWeek PreferredMonth PreferredHour".split()
DOUBLES = (
    "MonetaryTotal MonetaryAvg MonetaryStd MonetaryMin MonetaryMax TotalQuantity MinQuantity MaxQuantity "
    "AvgQuantityPerTransaction WeekendPurchaseRatio AvgDaysBetweenPurchases AvgProductsPerTransaction AvgLinesPerInvoice "
    "ReturnRatio AccountBalance Age SupportTicketsCount SatisfactionScore"
).split()
TEXTS = "Country Region CustomerType OrderPriority RegistrationDate Gender NewsletterSubscribed LastLoginIP".split()
EVERY = [*LONGS, *INTS, *DOUBLES, *TEXTS]
NUMERIC = [c for c in (*LONGS, *INTS, *DOUBLES) if c not in (KEY, TARGET)]

CLUSTER_FEATURES = ["Frequency", "TotalTransactions", "CustomerTenureDays", "FirstPurchaseDaysAgo"]
CENTRES = [[6.0, 24.0, 1500.0, 1800.0], [10.0, 40.0, 1750.0, 1900.0], [15.0, 60.0, 1850.0, 1950.0]]


def with_profile_fixture(customers: DataFrame) -> DataFrame:
    """Profile columns the tables do not hold, made from the key: gaps, sentinels, mixed date formats."""
    key, registered = F.col(KEY), F.to_date("RegistrationDate")
    return customers.withColumns(
        {
            "Age": F.when(key % 10 >= 3, (18 + (key * 7919) % 63).cast("double")),
            "SupportTicketsCount": F.when(key % 20 == 0, -1.0).when(key % 33 == 1, 999.0).otherwise((key % 16).cast("double")),
            "SatisfactionScore": F.when(key % 25 == 0, -1.0).when(key % 25 == 1, 99.0).otherwise((key % 51) / 10),
            "Gender": F.when(key % 10 != 9, F.when(key % 2 == 0, "F").otherwise("M")),
            "NewsletterSubscribed": F.lit("Yes"),
            "RegistrationDate": F.when(key % 3 == 0, F.date_format(registered, "dd/MM/yy"))
            .when(key % 3 == 1, F.date_format(registered, "yyyy-MM-dd"))
            .otherwise(F.date_format(registered, "MM/dd/yyyy")),
            "LastLoginIP": F.when(key % 101 == 0, "bad").otherwise(
                F.concat_ws(".", (key * 37) % 256, (key * 11) % 256, (key * 7) % 256, key % 256)
            ),
        }
    )


class Workbench:
    def __init__(self, spark: SparkSession, sf_dir: str, sizes: TrainingSizes = TrainingSizes()) -> None:
        self.spark, self.sf_dir, self.sizes = spark, sf_dir, sizes

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def path(self, name: str) -> str:
        return new_path(self.spark, name)

    @cached_property
    def customers(self) -> DataFrame:
        with small_tasks(self.spark):
            return stage(with_profile_fixture(customer360(self.spark, self.sf_dir)), "customer360")

    @cached_property
    def split(self) -> DataFrame:
        return stratified_split(self.customers, TARGET, KEY)

    @property
    def scored(self) -> DataFrame:
        """(CustomerID, label, score): a fixed logistic score with ties and exact bounds."""
        z = 0.003 * F.col("Recency") - 0.1 * F.col("Frequency")
        key = F.col(KEY)
        score = F.round(1 / (1 + F.exp(-z)), 2)
        for rest, value in enumerate((0.0, 0.25, 0.5, 0.75, 1.0)):
            score = F.when(key % 50 == rest, F.lit(value)).otherwise(score)
        return self.customers.select(key, F.col(TARGET).alias("label"), score.alias("score"))

    @property
    def report(self) -> DataFrame:
        """The score as a churn report: decision, level, correctness."""
        p = F.col("score")
        return self.scored.select(
            KEY,
            "label",
            "score",
            decide(p).alias("churn_predicted"),
            risk_level(p).alias("risk_level"),
            (decide(p) == F.col("label")).alias("correct"),
        )

    @property
    def spend(self) -> DataFrame:
        """(CustomerID, y, yhat): spend and a fixed multiple of the quantity."""
        return self.customers.where(F.col("MonetaryTotal").isNotNull()).select(
            KEY, F.col("MonetaryTotal").alias("y"), (F.col("TotalQuantity") * 2100.0).alias("yhat")
        )

    @property
    def clustered(self) -> DataFrame:
        return assign(self.customers, CLUSTER_FEATURES, CENTRES)

    @property
    def scenarios(self) -> DataFrame:
        """What-if inputs as text, with blank, unreadable and missing cells."""
        return self.scenarios_with()

    def scenarios_with(self, *columns: str) -> DataFrame:
        """The scenarios with further columns of their customers."""
        key = F.col(KEY)

        def text(value, period: int):
            shown = value.cast("string")
            return (
                F.when(key % period == 0, F.lit("  "))
                .when(key % period == 1, F.lit("n/a"))
                .when(key % period == 2, F.lit(None).cast("string"))
                .otherwise(shown)
            )

        c = F.col
        return self.customers.select(
            key,
            *columns,
            text(c("Frequency"), 7).alias("Frequency"),
            text(c("TotalQuantity").cast("int"), 8).alias("MonetaryTotal"),
            text(c("MinQuantity").cast("int") * 10, 9).alias("MonetaryAvg"),
            text(c("CustomerTenureDays"), 10).alias("CustomerTenureDays"),
            text(c("PreferredDayOfWeek") / 8, 11).alias("ReturnRatio"),
            text(c("SupportTicketsCount").cast("int"), 12).alias("SupportTicketsCount"),
            text(c("PreferredMonth").cast("int"), 13).alias("SatisfactionScore"),
            text(c("Age").cast("int"), 14).alias("Age"),
            text(2000 + c("PreferredDayOfWeek"), 15).alias("RegYear"),
            text(c("PreferredMonth"), 16).alias("RegMonth"),
        )

    @cached_property
    def prepared(self) -> Prepared:
        return prepare(self.customers, importance_trees=self.sizes.importance_trees)

    @cached_property
    def trained(self) -> Training:
        """Every model is fitted when first asked for."""
        return Training(self.prepared, self.sizes)

    @property
    def bundle(self) -> Bundle:
        return bundle_of(self.trained)

    @property
    def test_customers(self) -> DataFrame:
        return self.split.where("split = 'test'").drop("split")


_open: dict[tuple, Workbench] = {}


def workbench(spark: SparkSession, sf_dir: str) -> Workbench:
    """The shared workbench of a session and folder; tables are taken as they are when it is first used."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        for old in [k for k in _open if k[0] != key[0]]:
            del _open[old]
        _open[key] = Workbench(spark, sf_dir)
    return _open[key]


QUERIES: dict[str, callable] = {}
EXPECTED_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query over the workbench and, where it can be stated, the SQL of its result."""

    def wrap(function):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = lambda spark, sf_dir: function(workbench(spark, sf_dir))
        if sql is not None:
            EXPECTED_SQL[name] = sql
        return function

    return wrap
