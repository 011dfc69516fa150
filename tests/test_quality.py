import pytest
from pyspark.sql import functions as F

from conftest import pairs
from tidemark.operators import quality as q

CONTRACT = {
    "required_columns": ["id", "kind", "amt"],
    "not_null": ["id", "amt"],
    "unique": ["id"],
    "allowed_values": {"kind": ["a", "b"]},
    "ranges": {"amt": {"min": -100, "max": 100}},
    "row_count": {"tolerance_pct": 40},
}


def results(df, contract=CONTRACT):
    return {r.check: (r.outcome, r.detail) for r in q.validate(df, contract).collect()}


def test_clean_data_only_warns(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", -5), (3, "a", 99)], "id int, kind string, amt int")
    got = results(df)
    assert {k for k, v in got.items() if v[0] != "pass"} == {"row_count_tolerance"}
    assert q.gate(q.validate(df, CONTRACT)).first().outcome == "warn"
    assert [r.check for r in q.validate(df, CONTRACT).orderBy("ord").collect()] == q.check_names(CONTRACT)


def test_each_violation_is_caught(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "z", 250), (None, "b", -5)], "id int, kind string, amt int")
    got = results(df)
    assert got["not_null[id]"] == ("fail", "1 null(s)")
    assert got["unique[id]"] == ("fail", "1 duplicate(s)")
    assert got["allowed_values[kind]"] == ("fail", "unexpected: ['z']")
    assert got["range[amt]"] == ("fail", "1 outside [-100,100]")
    assert q.gate(q.validate(df, CONTRACT)).first().outcome == "fail"


def test_missing_column(spark):
    got = results(spark.createDataFrame([(1, 5)], "id int, amt int"))
    assert got["required_columns"] == ("fail", "missing: ['kind']")
    assert got["allowed_values[kind]"] == ("fail", "column absent")
    assert got["not_null[id]"][0] == "pass"


def test_empty_table(spark):
    got = results(spark.createDataFrame([], "id int, kind string, amt int"))
    assert {v[0] for k, v in got.items() if k != "row_count_tolerance"} == {"pass"}


def test_repeated_nulls_count(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    assert q.count_repeats(df, "id").first().n == 1


def test_ranges(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (5.0,), (200.0,)], "amt double")
    both = q.count_broken(df, {"ranges": {"amt": {"min": 0, "max": 100}}, "not_null": ["amt"]})
    assert pairs(both) == [("not_null[amt]", 2), ("range[amt]", 1)]
    half = q.count_broken(df, {"ranges": {"amt": {"max": 100}}})
    assert pairs(half) == [("range[amt]", 0)]


def test_long_value_lists_stay_whole(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("kind"))
    contract = {"allowed_values": {"kind": ["7"]}}
    outcome, detail = results(df, contract)["allowed_values[kind]"]
    assert outcome == "fail" and detail == f"unexpected: {sorted(str(i) for i in range(3000) if i != 7)}"
    assert q.unexpected_values(df, contract).count() == 2999


def test_row_rules_share_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    contract = {"not_null": ["l_orderkey"], "ranges": {"l_tax": {"min": 0, "max": 1}, "l_discount": {"min": 0, "max": 1}}}
    plan = q.count_broken(df, contract)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double,l_tax:double>" in plan


def test_gold_bounds(spark):
    kpi = spark.createDataFrame([("d", None, float("nan"), 11.0)],
                                "date string, npl_rate_pct double, digital_channel_mix_pct double, loan_to_deposit_ratio double")
    assert pairs(q.gold_checks(kpi).select("kpi", "outcome")) == [
        ("digital_channel_mix_pct", "fail"), ("loan_to_deposit_ratio", "fail"), ("npl_rate_pct", "pass")]


def test_quarantine_loses_nothing(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "z", 250), (None, "b", -5)], "id int, kind string, amt int")
    clean, bad = q.quarantine(df, CONTRACT)
    assert pairs(clean) == [(1, "a", 10)]
    rules = {r.kind: r.failed for r in bad.collect()}
    assert rules == {"z": ["allowed_values[kind]", "range[amt]"], "b": ["not_null[id]"]}


@pytest.mark.parametrize("outcome,layer,retries,asked,action", [
    ("pass", "bronze", 0, None, "proceed"), ("warn", "silver", 0, "halt", "proceed"),
    ("fail", "bronze", 0, None, "halt"), ("fail", "bronze", 0, "maybe", "halt"),
    ("fail", "bronze", 0, "retry", "retry"), ("fail", "bronze", 1, "RETRY ", "escalate"),
    ("fail", "silver", 0, "proceed", "proceed"), ("fail", "silver", 0, "escalate", "escalate"),
    ("fail", "gold", 0, None, "proceed"),
])
def test_gate_decision(spark, outcome, layer, retries, asked, action):
    df = spark.createDataFrame([(outcome, layer, retries, asked)], "outcome string, layer string, retries int, requested string")
    assert q.gate_decision(df).first().action == action
