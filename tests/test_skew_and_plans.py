"""Hot keys, and plans that must stay inside the JVM and off single tasks."""

import datetime as dt
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from basketlens.functions import cleaning, risk, whatif
from basketlens.operators import evaluate, profile
from basketlens.operators.clustering import assign
from basketlens.operators.split import stratified_split
from basketlens.registry import workbench
from basketlens.registry.base_sql import C360
from basketlens.registry.workbench import CENTRES, CLUSTER_FEATURES, with_profile_fixture
from basketlens.sources.customer360 import customer360
from basketlens.staging import checkpoint_root, stage

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """A third of the orders is one customer's, a third of the lines is one order's, part and supplier's."""
    folder = str(tmp_path_factory.mktemp("hot"))
    for name in "region nation customer supplier part events".split():
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    hot = F.col("o_orderkey") % 3 == 0
    orders.withColumn("o_custkey", F.when(hot, F.lit(7)).otherwise(F.col("o_custkey"))).write.parquet(f"{folder}/orders.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("third", F.col("l_orderkey") % 3 == 1)
    for column, value in (("l_orderkey", 4), ("l_partkey", 9), ("l_suppkey", 2)):
        lines = lines.withColumn(column, F.when(F.col("third"), F.lit(value)).otherwise(F.col(column)).cast("long"))
    lines.drop("third").write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_hot_keys_give_whole_results(spark, hot_tables, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = with_profile_fixture(customer360(spark, hot_tables)).orderBy("CustomerID").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    con = duckdb.connect()
    for name in "region nation customer supplier part events orders lineitem".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{hot_tables}/{name}.parquet/*.parquet'")
    want = con.execute(f"WITH {C360} SELECT * FROM c360 ORDER BY CustomerID")
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got[0].asDict())
    for mine, theirs in zip(got, want.fetchall(), strict=True):
        for column, b in zip(columns, theirs, strict=True):
            a = mine[column]
            assert a == (pytest.approx(b, rel=1e-9) if isinstance(b, float) else b), column


def test_customer_without_lines_and_with_one_order(spark, tmp_path):
    folder = str(tmp_path)
    for name in "region nation supplier part events lineitem".split():
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    spark.read.parquet(f"{SF}/customer.parquet").where("c_custkey < 3").write.parquet(f"{folder}/customer.parquet")
    day = dt.datetime(1999, 1, 2)
    later = dt.datetime(2001, 1, 1)
    spark.createDataFrame(
        [(10**12, 0, "O", 1.0, day, "1-URGENT"), (10**12 + 1, 1, "P", 1.0, later, "5-LOW")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{folder}/orders.parquet")
    (row,) = customer360(spark, folder).collect()
    assert (row["CustomerID"], row["Churn"], row["Frequency"], row["TotalTransactions"]) == (0, 1, 1, 0)
    assert row["MonetaryTotal"] is None and row["AvgDaysBetweenPurchases"] is None and row["ReturnRatio"] is None


def test_no_python_in_row_level_plans(spark):
    customers = stage(with_profile_fixture(customer360(spark, SF)), "plan")
    split = stratified_split(customers, "Churn", "CustomerID")
    tables = [
        cleaning.add_ratios(cleaning.flag_private(cleaning.date_parts(customers))),
        customers.select(risk.recommendations(risk.risk_level(F.col("ReturnRatio")), F.col("MonetaryTotal"), F.col("MonetaryAvg"), F.col("Frequency"))),
        whatif.with_defaults(customers).select(*whatif.derived_features().values()),
        assign(customers, CLUSTER_FEATURES, CENTRES),
        split,
    ]
    for df in tables:
        text = plan(df)
        assert "EvalPython" not in text and "MapInPandas" not in text and "Exchange" not in text


def test_single_partition_exchange_only_above_aggregates(spark):
    customers = stage(with_profile_fixture(customer360(spark, SF)), "plan")
    for df in (profile.duplicate_rows(customers), evaluate.regression_metrics(customers, "MonetaryTotal", "MonetaryAvg"),
               evaluate.confusion_matrix(customers, "Churn", "Churn")):
        lines = plan(df).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "Aggregate" in lines[i + 1]


def test_scans_read_only_what_is_used(spark):
    text = plan(customer360(spark, SF))
    assert "c_name" not in text and "l_tax" not in text and "o_totalprice" not in text and "props" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    customers = stage(with_profile_fixture(customer360(spark, SF)), "plan")
    scan = plan(customers.where("Churn = 1").select("Frequency"))
    assert "ReadSchema: struct<Churn:int,Frequency:bigint>" in scan and "EqualTo(Churn,1)" in scan


def test_staged_tables_live_in_the_shared_folder(spark):
    df = stage(spark.range(3).toDF("x"), "here")
    assert all(checkpoint_root(spark) in f for f in df.inputFiles())


def test_customer_table_reads_little_at_a_time(spark, monkeypatch):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before, seen = [spark.conf.get(k) for k in keys], []
    monkeypatch.setattr(workbench, "stage", lambda df, name: seen.append([spark.conf.get(k) for k in keys]) or df)
    found = workbench.Workbench(spark, SF).customers
    assert seen == [[str(16 << 20)] * 2] and [spark.conf.get(k) for k in keys] == before
    # Lines are near to distinct already: no aggregation keeps every (order, part, supplier).
    assert "keys=[l_orderkey, l_partkey, l_suppkey]" not in re.sub(r"#\d+L?", "", plan(found))
