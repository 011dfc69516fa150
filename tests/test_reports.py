import json

import pytest

import __spark_entry__ as entry
from conftest import SF, pairs
from tidemark import fixed
from tidemark.operators import quality
from tidemark.plans import reports


@pytest.fixture(scope="module")
def gold(spark):
    return entry.gold(spark, SF)


@pytest.mark.parametrize("text,field,value", [
    ("show me workforce attrition and retention", "domain", "hr"),
    ("operations channel uptime and sla", "domain", "operations"),
    ("finance executive overview for the board", "template", "finance_executive_overview"),
    ("loans activity by source", "template", "source_activity"),
    ("loans activity by source", "source", "loans"),
    ("a Trade by source", "source", "trades"),
    ("by source please", "source", "trades"),
    ("nothing that is known", "template", "finance_executive_overview"),  # a tie goes to the first
])
def test_routing(spark, text, field, value):
    row = reports.route_requests(spark.createDataFrame([(text,)], "request string")).first()
    assert row[field] == value


def test_source_only_where_the_template_takes_one(spark):
    row = reports.route_requests(spark.createDataFrame([("credit risk of loans npl arrears",)], "request string")).first()
    assert (row.template, row.source) == ("finance_credit_risk", None)


def test_template(gold):
    rows = reports.resolve(gold, fixed.TEMPLATES[3])
    assert {(r.visual, r.type) for r in rows.collect()} == {(1, "kpi_cards"), (2, "line"), (3, "bar")}
    assert rows.where("visual = 2").count() == 30


def test_absent_table_and_no_rows_give_empty(gold):
    hr = next(t for t in fixed.TEMPLATES if t["id"] == "hr_cost")
    assert pairs(reports.resolve(gold, hr).where("type = 'empty'").select("visual", "series")) == [
        (1, "gold.hr_headcount_daily")]
    by_source = fixed.TEMPLATES[-1]
    none = reports.resolve(gold, by_source, "no such source")
    assert pairs(none.where("type = 'empty'").select("visual")) == [(1,), (2,)]
    assert none.where("visual = 3").count() == 6  # the comparison is not scoped


def test_templates_are_governed(gold):
    bad = {"id": "x", "visuals": [("bar", "silver.fact_loan", "a", "b")]}
    with pytest.raises(ValueError):
        reports.resolve(gold, bad)
    with pytest.raises(ValueError):
        reports.resolve(gold, {"id": "x", "visuals": [("pie", "gold.kpi_daily", "a", "b")]})


def test_donut_is_a_bar(gold):
    donut = reports.resolve(gold, {"id": "x", "visuals": [("donut", "gold.loans_by_status", "status", "principal_outstanding_eur")]})
    assert {r.x for r in donut.collect()} == {"current", "delinquent", "default"}


def test_dashboard_json(gold):
    docs = {r.section: json.loads(r.json) for r in reports.dashboard_json(gold).collect()}
    assert set(docs) == {"latest", "series", "deposits_by_segment", "txn_by_channel", "loans_by_status"}
    assert set(docs["series"]) == set(fixed.DASHBOARD_SERIES)
    assert len(docs["series"]["total_deposits_eur"]) == 30
    assert docs["series"]["txn_count"][0]["x"] == "2024-01-01"


def test_newest_row_among_ties_is_one_and_the_same(spark):
    df = spark.createDataFrame([("d1", 9, 9), ("d2", 1, 5), ("d2", 2, 3), ("d2", 2, 4)], "date string, a int, b int")
    for n in (1, 3, 7):
        assert pairs(reports.cards(df.repartition(n), ["a", "b", "none"])) == [("a", 2.0), ("b", 4.0)]


def test_personal_columns_in_silver_fail(spark):
    tables = {"dim": spark.createDataFrame([], "id int, full_name string"), "fact": spark.createDataFrame([], "id int")}
    got = {r.details: r.outcome for r in quality.personal_checks(tables, {"customers": ("full_name",), "t": ("x",)}).collect()}
    assert got == {"customers: personal columns left: ['dim.full_name']": "fail", "t: no personal columns left": "pass"}
