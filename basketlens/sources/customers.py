"""Customer table: schema, column dialects, CSV and parquet sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

KEY = "CustomerID"
TARGET = "Churn"

# Columns that would leak the target.
LEAKAGE_COLUMNS = (
    "ChurnRisk",
    "ChurnRiskCategory",
    "CustomerType",
    "RFMSegment",
    "LoyaltyLevel",
    "AccountStatus",
    "Recency",
)

# Short column names and the long names used everywhere here.
SHORT_TO_LONG = {
    "AvgQtyPerTrans": "AvgQuantityPerTransaction",
    "CustomerTenure": "CustomerTenureDays",
    "FirstPurchase": "FirstPurchaseDaysAgo",
    "PreferredDay": "PreferredDayOfWeek",
    "WeekendRatio": "WeekendPurchaseRatio",
    "AvgDaysBetween": "AvgDaysBetweenPurchases",
    "UniqueDesc": "UniqueDescriptions",
    "AvgProdPerTrans": "AvgProductsPerTransaction",
    "NegQtyCount": "NegativeQuantityCount",
    "CancelledTrans": "CancelledTransactions",
    "TotalTrans": "TotalTransactions",
    "AvgLinesPerInv": "AvgLinesPerInvoice",
    "SupportTickets": "SupportTicketsCount",
    "Satisfaction": "SatisfactionScore",
    "SpendingCat": "SpendingCategory",
    "PreferredTime": "PreferredTimeOfDay",
    "WeekendPref": "WeekendPreference",
    "BasketSize": "BasketSizeCategory",
    "ProdDiversity": "ProductDiversity",
    "Monetary": "MonetaryTotal",
    "monetary_total": "MonetaryTotal",
}

_INTS = "Recency CustomerTenureDays FirstPurchaseDaysAgo PreferredDayOfWeek PreferredHour PreferredMonth Churn".split()
_LONGS = (
    "CustomerID Frequency UniqueProducts UniqueDescriptions UniqueCountries NegativeQuantityCount ZeroPriceCount "
    "CancelledTransactions TotalTransactions UniqueInvoices"
).split()
_DOUBLES = (
    "MonetaryTotal MonetaryAvg MonetaryStd MonetaryMin MonetaryMax TotalQuantity MinQuantity MaxQuantity "
    "AvgQuantityPerTransaction "
    "WeekendPurchaseRatio AvgDaysBetweenPurchases AvgProductsPerTransaction ReturnRatio AvgLinesPerInvoice "
    "Age SupportTicketsCount SatisfactionScore AccountBalance"
).split()
_TEXTS = (
    "RFMSegment CustomerType LoyaltyLevel ChurnRisk ChurnRiskCategory AccountStatus AgeCategory SpendingCategory "
    "FavoriteSeason PreferredTimeOfDay Region WeekendPreference BasketSizeCategory ProductDiversity Gender Country "
    "OrderPriority NewsletterSubscribed RegistrationDate LastLoginIP"
).split()

COLUMN_TYPES: dict[str, T.DataType] = {
    **{c: T.LongType() for c in _LONGS},
    **{c: T.IntegerType() for c in _INTS},
    **{c: T.DoubleType() for c in _DOUBLES},
    **{c: T.StringType() for c in _TEXTS},
}


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column order of a CSV table, read from its header line alone."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def canonical_names(df: DataFrame) -> DataFrame:
    """Rename short-dialect columns; a long name already present wins."""
    present = set(df.columns)
    renames: dict[str, str] = {}
    for short, long in SHORT_TO_LONG.items():
        if short in present and long not in present and long not in renames.values():
            renames[short] = long
    return df.withColumnsRenamed(renames)


def resolve_column(df: DataFrame, candidates: list[str]) -> str | None:
    """First candidate name the table has."""
    return next((c for c in candidates if c in df.columns), None)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers become NULL; every other column is passed through."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, floats) else F.col(f.name)
            for f in df.schema
        ]
    )


def _typed(column: Column, kind: T.DataType) -> Column:
    """A text cell as its declared type; ``12.0`` is a whole number, ``12.5`` is not."""
    text = F.trim(column)
    if isinstance(kind, T.StringType):
        return F.when(column != "", column)
    number = text.try_cast("double")
    if isinstance(kind, T.DoubleType):
        return number
    exact = text.try_cast("bigint")
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 2.0**53), number.cast("bigint"))
    return F.coalesce(exact, whole).try_cast(kind)


def _cells(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, T.DataType]]:
    header = header_columns(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.schema(schema).option("header", True).option("nullValue", "").option("enforceSchema", False).csv(path)
    return raw, {c: COLUMN_TYPES.get(SHORT_TO_LONG.get(c, c), T.StringType()) for c in header}


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw customer CSV in either dialect, with declared types; empty cells and NaN become NULL.

    Cells are read as text and converted, so whole numbers written with decimals (as a table
    with gaps is) are kept. What cannot be converted becomes NULL; ``unreadable_cells`` counts
    it. Columns outside the known vocabulary stay text, as no type is declared for them.
    """
    raw, kinds = _cells(spark, path)
    return nan_to_null(canonical_names(raw.select(*[_typed(F.col(c), k).alias(c) for c, k in kinds.items()])))


def unreadable_cells(spark: SparkSession, path: str) -> DataFrame:
    """(column, cells): cells of a CSV that hold something, but not the declared type."""
    raw, kinds = _cells(spark, path)
    empty = lambda c: F.col(c).isNull() | F.lower(F.trim(F.col(c))).isin("", "nan")
    counts = raw.agg(*[F.count_if(~empty(c) & _typed(F.col(c), k).isNull()).alias(c) for c, k in kinds.items()])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("cells")) for c in kinds])
    return counts.select(F.inline(cells)).where("cells > 0")


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(canonical_names(spark.read.parquet(path)))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Sink of cleaned tables, reports and profiles; one folder of part files per table."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_split(train: DataFrame, test: DataFrame, path: str) -> str:
    """Key, label and features of both sides in one table, one partition folder per side."""
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")), True)
    return write_table(both, path, partition_by=("split",))


def load_split(spark: SparkSession, path: str, side: str) -> DataFrame:
    """One side of a written split; the other folder is pruned, not read."""
    return spark.read.parquet(path).where(F.col("split") == side).drop("split")
