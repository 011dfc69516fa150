"""What has to hold when tables are large and keys are hot."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF, pairs
from tidemark.operators import star as st
from tidemark.plans import kpi, measures

HOT = 400_000


@pytest.fixture
def large_dims(spark):
    """No broadcast by size, and partitions that count as skewed early."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_postings(spark):
    """A third of the postings belong to one account, a tenth to none."""
    i = F.col("id")
    return spark.range(HOT, numPartitions=16).select(
        i.alias("txn_id"),
        F.when(i % 3 == 0, 7).when(i % 10 == 1, None).otherwise(i % 5000).alias("account_id"),
        F.lit("web").alias("channel"),
        F.lit(1).cast("decimal(18,2)").alias("amount_eur"),
        (20240101 + i % 5).cast("int").alias("date_sk"),
    )


def test_hot_account_is_split_by_the_skew_join(large_dims):
    spark = large_dims
    accounts = spark.range(5000).select(F.col("id").alias("account_id"), (F.col("id") + 1).alias("account_sk"))
    out = st.fact_account_keys(hot_postings(spark), accounts)
    out.write.format("noop").mode("overwrite").save()
    ran = st.fact_account_keys(hot_postings(spark), accounts)
    assert ran.agg(F.count(F.lit(1)), F.count("account_sk")).first()[0] == HOT
    counted = ran.groupBy("date_sk").count()
    counted.collect()
    assert "SortMergeJoin(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()


def test_hot_account_is_one_row_before_the_join(spark):
    """Beside a large dimension facts are combined before they look anything up."""
    star = replace(entry.star(spark, SF), lookup_first=False)
    dims = ["segment", "channel"]
    names = ["transaction_volume", "transaction_value", "active_customers"]
    large = measures.evaluate(star, names, dims)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    depth = {x: next(line for line in plan.splitlines() if x in line).index(x) for x in ("Join LeftOuter", "Aggregate [date_sk")}
    assert depth["Aggregate [date_sk"] > depth["Join LeftOuter"]
    small = measures.evaluate(replace(star, lookup_first=True), names, dims)
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    assert pairs(kpi.npl_by_product(star)) == pairs(kpi.npl_by_product(replace(star, lookup_first=True)))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.library_queries()))
def test_no_cross_join_and_no_python(large_dims, name):
    plan = plan_of(entry.library_queries()[name](large_dims, SF))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas", plan)


def test_one_scan_of_the_facts_with_pruned_columns(spark):
    plan = plan_of(kpi.txns_daily(entry.star(spark, SF)))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "events.parquet" in line]
    assert len(scans) == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in scans[0]
    seen = [x for x in plan_of(kpi.active_daily(entry.star(spark, SF))).splitlines() if "events.parquet" in x]
    assert len(seen) == 1 and "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in seen[0]


def test_loans_need_no_join(spark):
    plan = plan_of(kpi.net_loans(entry.star(spark, SF).fact_loan))
    assert "Join" not in plan
    assert "ReadSchema: struct<o_totalprice:double>" in plan
