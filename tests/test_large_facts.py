"""Facts beside large dimensions: never broadcast, shuffled once for a lookup, read once for growth."""

import re
from dataclasses import replace

import pytest

import __spark_entry__ as entry
from conftest import SF, pairs
from tidemark.operators import star as st
from tidemark.plans import kpi, measures
from tidemark.session import materialise


def plan_of(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("small", [True, False])
def test_the_facts_are_never_the_broadcast_side(spark, small):
    star = replace(entry.star(spark, SF), lookup_first=small)
    for mart in (kpi.deposits_by_segment(star), kpi.segment_growth(star)):
        joins = re.findall(r"(\w+Join) \[.*?\], \[.*?\], \w+, (Build\w+)", plan_of(mart))
        assert joins and {side for _, side in joins} == {"BuildRight"}
        assert {kind for kind, _ in joins} == {"BroadcastHashJoin" if small else "ShuffledHashJoin"}
    other = replace(star, lookup_first=not small)
    assert pairs(kpi.deposits_by_segment(star)) == pairs(kpi.deposits_by_segment(other))


def below_join(df):
    """The part of the plan under the lookup of the accounts."""
    plan = plan_of(df, "optimizedPlan")
    return plan[re.search(r"Join (Inner|LeftOuter)", plan).start():]


def test_loans_by_product_are_not_combined_before_the_lookup(spark):
    star = replace(entry.star(spark, SF), lookup_first=False)
    assert "Aggregate [date_sk" not in below_join(kpi.npl_by_product(star))


def test_snapshots_are_not_combined_before_the_lookup(spark):
    star, names = replace(entry.star(spark, SF), lookup_first=False), ["total_deposits", "net_loans", "npl_rate_pct"]
    large = measures.evaluate(star, names, ["date", "segment"])
    assert "Aggregate [date_sk" not in below_join(measures.evaluate(star, ["net_loans"], ["date", "segment"]))
    assert pairs(large) == pairs(measures.evaluate(replace(star, lookup_first=True), names, ["date", "segment"]))


def test_the_date_is_written_per_cell_and_not_per_fact(spark):
    star = replace(entry.star(spark, SF), lookup_first=False)
    lower = below_join(measures.evaluate(star, ["net_loans"], ["date", "segment"]))
    assert "date_format" not in lower and "make_date" not in lower


def test_growth_works_its_cells_out_once(spark):
    grown = measures.evaluate(entry.star(spark, SF), ["deposits_growth_pct", "loans_growth_pct"], ["date", "segment"])
    assert "orders.parquet" not in plan_of(grown) and grown.count() > 0


def test_dimensions_are_measured_unpacked(spark):
    """Files far below the threshold, rows beyond it: no join sends the dimension through the driver."""
    keys = spark.range(120_000).selectExpr("id customer_id", "id + 1 customer_sk", "id account_id", "id + 1 account_sk")
    dim = materialise(keys, "dim")
    packed = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(packed + 1))
    try:
        assert not st.below_broadcast(dim) and st.below_broadcast(dim.limit(10)) and not st.below_broadcast(dim.limit(10), dim)
        for out in (
            st.dim_account_customer(dim.select("account_id", "customer_id"), dim),
            st.fact_account_keys(dim.select("account_id", "customer_id"), dim),
        ):
            assert "BroadcastHashJoin" not in plan_of(out) and out.count() == 120_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
