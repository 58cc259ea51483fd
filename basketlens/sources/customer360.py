"""Customer-360 table derived from the transaction tables.

Lines are reduced to (order, part), then to one row per order, before they meet
the orders, so a customer or order holding a large share of the lines is combined
map-side and spread over tasks; the distinct counts meet the orders line by line, where
Spark splits a skewed partition. Bounded domains (weekday, month, hour) are counted in plain
aggregate columns, which needs no shuffle of their own. No join carries a
broadcast hint: Spark broadcasts a side when its size is known to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DEFAULT_CUTOFF = "2000-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counts(value: Column, low: int, high: int) -> Column:
    return F.array(*[F.count_if(value == F.lit(v)) for v in range(low, high + 1)])


def _first_mode(counts: str, low: int) -> Column:
    """Most frequent value of a counted domain, the smallest on ties, NULL when nothing was counted."""
    best = F.array_max(counts)
    return F.when(best > 0, (F.array_position(counts, best) - 1 + low).cast("int"))


def _order_measures(lineitem: DataFrame, history: DataFrame) -> DataFrame:
    # Exact money: sums of decimals do not depend on the order the rows arrive in.
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    per_part = lineitem.groupBy("l_orderkey", "l_partkey").agg(
        F.sum(net).alias("net"),
        F.sum("l_quantity").alias("quantity"),
        F.min("l_quantity").alias("min_quantity"),
        F.max("l_quantity").alias("max_quantity"),
        F.count("*").alias("lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_extendedprice") == 0).alias("zero_price"),
    )
    # One row per order before the join, so no order can skew it.
    per_order = per_part.groupBy("l_orderkey").agg(
        F.sum("net").cast("decimal(38,4)").alias("net"),
        *[F.sum(c).alias(c) for c in ("quantity", "lines", "returned", "zero_price")],
        F.min("min_quantity").alias("min_quantity"),
        F.max("max_quantity").alias("max_quantity"),
        F.count("*").alias("parts"),
    )
    owned = history.select("o_orderkey", "o_custkey").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return owned.groupBy("o_custkey").agg(
        F.sum("net").cast("double").alias("MonetaryTotal"),
        (F.sum("net").cast("double") / F.count("*")).alias("MonetaryAvg"),
        F.when(F.count("*") > 1, F.stddev_samp(F.col("net").cast("double"))).alias("MonetaryStd"),
        F.min("net").cast("double").alias("MonetaryMin"),
        F.max("net").cast("double").alias("MonetaryMax"),
        F.sum("quantity").alias("TotalQuantity"),
        F.min("min_quantity").alias("MinQuantity"),
        F.max("max_quantity").alias("MaxQuantity"),
        F.count("*").alias("orders_with_lines"),
        F.avg("parts").alias("AvgProductsPerTransaction"),
        F.sum("lines").alias("line_count"),
        F.sum("returned").alias("returned_lines"),
        F.sum("zero_price").alias("zero_price_lines"),
    )


def _distinct_counts(lineitem: DataFrame, history: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    # No distinct before the counts: nearly every line is a row of its own, and the counts combine map-side.
    bought = (
        lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
        .join(history.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey", "l_partkey", "l_suppkey")
    )
    return (
        bought.join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .groupBy("o_custkey")
        .agg(
            F.countDistinct("l_partkey").alias("UniqueProducts"),
            F.countDistinct("p_name").alias("UniqueDescriptions"),
            F.countDistinct("s_nationkey").alias("UniqueCountries"),
        )
    )


def _order_profile(orders: DataFrame, cutoff: str) -> DataFrame:
    before = F.col("o_orderdate") < F.lit(cutoff).cast("timestamp_ntz")
    day = F.when(before, F.weekday("o_orderdate"))
    return (
        orders.groupBy("o_custkey")
        .agg(
            F.count_if(before).alias("Frequency"),
            F.count_if(~before).alias("later_orders"),
            F.max(F.when(before, F.col("o_orderdate"))).cast("date").alias("last_order"),
            F.min(F.when(before, F.col("o_orderdate"))).cast("date").alias("first_order"),
            F.count_if(day >= 5).alias("weekend_orders"),
            F.count_if(before & (F.col("o_orderstatus") == "P")).alias("CancelledTransactions"),
            _counts(day, 0, 6).alias("by_weekday"),
            _counts(F.when(before, F.month("o_orderdate")), 1, 12).alias("by_month"),
        )
        .where(F.col("Frequency") > 0)
    )


def _favourite_priority(history: DataFrame) -> DataFrame:
    counted = history.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    return counted.groupBy("o_custkey").agg(
        F.min(F.struct(-F.col("n"), F.col("o_orderpriority")))["o_orderpriority"].alias("OrderPriority")
    )


def customer360(spark: SparkSession, sf_dir: str, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """One row per customer with an order before ``cutoff``; churned when none follows it."""
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    history = orders.where(F.col("o_orderdate") < F.lit(cutoff).cast("timestamp_ntz"))
    hours = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(_counts(F.hour("ts"), 0, 23).alias("by_hour"))
    )
    home = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    key = F.col("c_custkey")
    joined = (
        table(spark, sf_dir, "customer")
        .join(_order_profile(orders, cutoff), key == F.col("o_custkey"))
        .drop("o_custkey")
    )
    for side in (
        _order_measures(lineitem, history),
        _distinct_counts(lineitem, history, table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")),
        _favourite_priority(history),
    ):
        joined = joined.join(side, key == F.col("o_custkey"), "left").drop("o_custkey")
    joined = joined.join(hours, key == F.col("user_id"), "left").join(
        home, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    tenure = F.date_diff("last_order", "first_order")
    lines = F.coalesce("line_count", F.lit(0))
    return joined.select(
        key.cast("long").alias("CustomerID"),
        F.when(F.col("later_orders") > 0, 0).otherwise(1).alias("Churn"),
        F.date_diff(F.lit(cutoff).cast("date"), "last_order").alias("Recency"),
        "Frequency",
        F.col("Frequency").alias("UniqueInvoices"),
        "MonetaryTotal",
        "MonetaryAvg",
        "MonetaryStd",
        "MonetaryMin",
        "MonetaryMax",
        "TotalQuantity",
        "MinQuantity",
        "MaxQuantity",
        (F.col("TotalQuantity") / F.col("orders_with_lines")).alias("AvgQuantityPerTransaction"),
        tenure.alias("CustomerTenureDays"),
        F.date_diff(F.lit(cutoff).cast("date"), "first_order").alias("FirstPurchaseDaysAgo"),
        _first_mode("by_weekday", 0).alias("PreferredDayOfWeek"),
        _first_mode("by_month", 1).alias("PreferredMonth"),
        _first_mode("by_hour", 0).alias("PreferredHour"),
        (F.col("weekend_orders") / F.col("Frequency")).alias("WeekendPurchaseRatio"),
        F.when(F.col("Frequency") > 1, tenure / F.greatest(F.col("Frequency") - 1, F.lit(1))).alias(
            "AvgDaysBetweenPurchases"
        ),
        "UniqueProducts",
        "UniqueDescriptions",
        "UniqueCountries",
        "AvgProductsPerTransaction",
        lines.alias("TotalTransactions"),
        (lines / F.col("Frequency")).alias("AvgLinesPerInvoice"),
        F.coalesce("returned_lines", F.lit(0)).alias("NegativeQuantityCount"),
        F.try_divide("returned_lines", "line_count").alias("ReturnRatio"),
        "CancelledTransactions",
        F.coalesce("zero_price_lines", F.lit(0)).alias("ZeroPriceCount"),
        F.col("c_acctbal").alias("AccountBalance"),
        F.col("n_name").alias("Country"),
        F.col("r_name").alias("Region"),
        F.col("c_mktsegment").alias("CustomerType"),
        "OrderPriority",
        F.date_format("first_order", "yyyy-MM-dd").alias("RegistrationDate"),
    )
