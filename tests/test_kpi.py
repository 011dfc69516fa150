from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF, pairs
from tidemark import fixed
from tidemark.operators import profile
from tidemark.operators.star import Star
from tidemark.plans import kpi, measures


def make_star(spark, txns, balances, loans):
    none = spark.range(0)
    return Star(
        dim_customer=spark.createDataFrame([(10, "retail"), (20, None)], "customer_sk long, segment string"),
        dim_account=spark.createDataFrame(
            [(1, 10, "savings"), (2, 10, "loan"), (3, 20, "savings")],
            "account_sk long, customer_sk long, product_type string"),
        dim_channel=spark.createDataFrame(
            [(1, "mobile", True), (2, "atm", False)], "channel_sk int, channel string, is_digital boolean"),
        dim_product=none,
        fact_transaction=spark.createDataFrame(
            txns, "date_sk int, account_sk long, channel_sk int, amount_eur decimal(18,2), txn_type string"
        ).withColumns({"is_fee": F.col("txn_type") == "fee", "is_interest": F.col("txn_type") == "interest"}),
        fact_account_balance=spark.createDataFrame(
            balances, "date_sk int, account_sk long, balance_eur decimal(18,2), is_deposit boolean"),
        fact_loan=spark.createDataFrame(
            loans, "date_sk int, account_sk long, principal_outstanding_eur decimal(18,2), days_past_due int"
        ).withColumn("is_npl", F.col("days_past_due") >= 90),
    )


@pytest.fixture
def star(spark):
    """Three run days, one calendar day missing; the last one has no postings."""
    return make_star(
        spark,
        [(20240101, 1, 1, D("10.00"), "deposit"), (20240101, 1, 2, D("-4.00"), "fee"),
         (20240101, 3, None, D("6.00"), "interest"), (20240101, None, 1, D("-1.00"), "payment"),
         (20240103, 3, 1, D("5.00"), "interest"), (20231231, 1, 1, D("99.00"), "deposit")],
        [(20240101, 1, D("100.00"), True), (20240101, 2, D("50.00"), False), (20240101, 3, D("20.00"), True),
         (20240103, 1, D("132.00"), True), (20240105, 1, D("0.00"), True)],
        [(20240101, 2, D("40.00"), 0), (20240101, 2, D("10.00"), 90), (20240103, 2, D("0.00"), 5),
         (20240105, 2, D("30.00"), 20000)],
    )


def test_kpi_rows(star):
    rows = {r.date: r for r in kpi.kpi_daily(star).collect()}
    assert sorted(rows) == ["2024-01-01", "2024-01-03", "2024-01-05"]  # 2023-12-31 has postings only
    a, b, e = (rows[d] for d in sorted(rows))
    assert (a.total_deposits_eur, a.deposits_growth_pct, b.deposits_growth_pct) == (120.0, None, 10.0)
    assert (a.net_loans_eur, b.loans_growth_pct, e.loans_growth_pct) == (50.0, -100.0, None)
    assert a.loan_to_deposit_ratio == 0.4167 and e.loan_to_deposit_ratio is None
    assert (a.nim_pct, b.nim_pct) == (12.0, None)
    assert (a.fee_income_eur, a.txn_count, a.txn_value_eur) == (4.0, 4, 21.0)
    assert (a.npl_rate_pct, b.npl_rate_pct) == (20.0, None)
    assert (a.active_customers, b.active_customers, b.net_new_customers) == (2, 1, -1)
    assert a.digital_channel_mix_pct == 66.67  # the posting without a channel is left out
    assert (e.txn_count, e.txn_value_eur, e.fee_income_eur, e.active_customers) == (0, 0.0, 0.0, 0)
    assert e.digital_channel_mix_pct is None and e.net_new_customers == -1


def test_prior_row_gives_growth(star):
    whole = kpi.kpi_daily(star)
    days = star.__class__(**{**star.__dict__, "fact_account_balance": star.fact_account_balance.where("date_sk > 20240101"),
                             "fact_loan": star.fact_loan.where("date_sk > 20240101")})
    prior = kpi.latest_row(whole.where("date < '2024-01-03'"))
    assert pairs(kpi.kpi_daily(days, prior).select("date", "deposits_growth_pct", "net_new_customers")) == pairs(
        whole.where("date > '2024-01-01'").select("date", "deposits_growth_pct", "net_new_customers"))


def test_calendar_growth_sees_the_gap(star):
    got = kpi.growth_calendar_day(kpi.total_deposits(star.fact_account_balance), "total_deposits_eur")
    assert [r.growth_pct for r in got.collect()] == [None, None, None]


def test_marts_drop_missing_groups(star):
    assert pairs(kpi.deposits_by_segment(star).where("date = '2024-01-01'")) == [("2024-01-01", "retail", 100.0)]
    assert pairs(kpi.txn_by_channel(star).where("date = '2024-01-01'")) == [
        ("2024-01-01", "atm", False, 1, 4.0), ("2024-01-01", "mobile", True, 2, 11.0)]
    assert pairs(kpi.loans_by_status(star.fact_loan)) == [
        ("2024-01-01", "current", 40.0), ("2024-01-01", "default", 10.0), ("2024-01-03", "delinquent", 0.0)]


def test_segments_add_up_to_the_total(spark):
    import __spark_entry__ as entry

    star = entry.star(spark, SF)
    total = {r.date: r.total_deposits_eur for r in kpi.total_deposits(star.fact_account_balance).collect()}
    parts = kpi.deposits_by_segment(star).groupBy("date").agg(F.sum("deposits_eur").alias("t")).collect()
    assert {r.date: round(r.t, 2) for r in parts} == {d: round(v, 2) for d, v in total.items()}
    one = measures.evaluate(star, ["total_deposits"], ["product_type"]).agg(F.sum("total_deposits")).first()[0]
    assert round(one, 2) == round(total[max(total)], 2)  # without the date, the last day


def test_measures_check_their_grain(star):
    with pytest.raises(ValueError):
        measures.evaluate(star, ["net_loans"], ["channel"])
    with pytest.raises(ValueError):
        measures.evaluate(star, ["net_loans"], ["date"], "rollup")
    got = measures.evaluate(star, ["transaction_volume", "net_loans"], ["channel"])
    assert {r.channel: (r.transaction_volume, r.net_loans) for r in got.collect()} == {
        "mobile": (4, 30.0), "atm": (1, 30.0), None: (1, 30.0)}
    dated = measures.evaluate(star, ["transaction_volume", "net_loans"], ["date", "channel"])
    assert {(r.date, r.channel): r.net_loans for r in dated.collect()}[("2024-01-01", "atm")] == 50.0


def test_only_asked_dimensions_are_looked_up(star):
    total = measures.evaluate(star, ["transaction_volume", "net_loans", "total_deposits"], [])
    assert tuple(total.first()) == (6, 30.0, 0.0)
    flat = measures.evaluate(star, ["transaction_value", "npl_rate_pct"], ["date"])
    assert "Join" not in flat._jdf.queryExecution().optimizedPlan().toString()
    assert {r.date: r.transaction_value for r in flat.collect()}["2024-01-01"] == 21.0


def test_approximate_customers_are_close(star):
    exact = dict(pairs(kpi.active_customers(star)))
    assert dict(pairs(kpi.active_customers(star, approximate=True))) == exact


def test_transpose(star):
    wide = kpi.kpi_transpose(kpi.kpi_daily(star))
    assert wide.columns == ["kpi", "2024-01-01", "2024-01-03", "2024-01-05"]
    assert wide.count() == len(fixed.KPI_COLUMNS)


def test_row_count_tolerance(spark):
    counts = [10, 10, 13, 17, 2]
    rows = [(f"2024-01-{i + 1:02d}",) for i, n in enumerate(counts) for _ in range(n)]
    got = kpi.trailing_row_count(spark.createDataFrame(rows, "day string"), "day").orderBy("date")
    assert [r.outcome for r in got.collect()] == ["warn", "pass", "warn", "fail", "fail"]


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 6.0)], "k string, v double")
    assert pairs(profile.value_counts(df, ["k"])) == [("k", "a", 2)]
    assert tuple(profile.numeric_profile(df, "v").first()) == (1.0, 6.0, 3.0)
    assert profile.share_of(df, share=F.col("k") == "a").first().share == pytest.approx(200 / 3)
