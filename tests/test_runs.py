import pytest
from pyspark.sql import functions as F

from conftest import SF, pairs
from tidemark import fixed
from tidemark.plans import runs
from tidemark.session import scratch
from tidemark.sources import bank, bronze

D1, D2 = "2024-01-10", "2024-01-11"
CONTRACTS = {**fixed.CONTRACTS, "customers": {**fixed.CONTRACTS["customers"], "allowed_values": {}}}


def sources(spark, day, spoil=False):
    """The sources as they stand on a day; accounts and loans are snapshots of it."""
    spoiled = spoil if callable(spoil) else lambda: spoil

    def txns():
        df = bank.transactions(spark, SF)
        if spoiled():
            first = df.where(F.to_date("posting_ts") == day).limit(1)
            df = df.unionByName(first)  # a key that repeats
        return df

    at = F.col("snapshot_date") == F.lit(day).cast("date")
    cfg = bronze.SourceConfig
    return [
        cfg("accounts", "accounts", lambda: bank.account_snapshots(spark, SF).where(at), "full", "snapshot_date",
            "bronze.accounts", (), "accounts"),
        cfg("core_transactions", "transactions", txns, "incremental", "posting_ts", "bronze.transactions",
            ("counterparty",), "transactions"),
        cfg("customers", "customers", lambda: bank.customers(spark, SF), "full", "onboarded_date",
            "bronze.customers", ("full_name",), "customers"),
        cfg("loans", "loans", lambda: bank.loan_snapshots(spark, SF).where(at), "full", "snapshot_date",
            "bronze.loans", (), "loans"),
    ]


def lookups(spark):
    return {"reference_products": bank.products(spark), "reference_branches": bank.branches(spark),
            "reference_channels": bank.channels(spark)}


def day(spark, lake, d, **options):
    spoil = options.pop("spoil", False)
    return runs.run_day(spark, lake, sources(spark, d, spoil), lookups(spark), d, CONTRACTS, salt="s", **options)


def test_two_days_and_a_rerun(spark, lake):
    import __spark_entry__ as entry
    from tidemark.plans import kpi

    path = scratch(spark, "manifests")
    first = day(spark, lake, D1, manifests=path)
    assert first.status == "success" and set(first.stages.values()) == {"passed"}
    second = day(spark, lake, D2, manifests=path)
    assert second.status == "success"

    cols = ["date", "total_deposits_eur", "net_loans_eur", "txn_count", "txn_value_eur", "active_customers"]
    whole = kpi.kpi_daily(entry.star(spark, SF)).where(F.col("date").isin(D1, D2))
    stored = lake.scan("gold.kpi_daily")
    assert pairs(stored.select(*cols)) == pairs(whole.select(*cols))
    growth = dict(pairs(stored.select("date", "deposits_growth_pct")))
    assert growth[D1] is None
    assert growth[D2] == whole.where(F.col("date") == D2).first().deposits_growth_pct

    # nothing personal and no currency in silver
    assert "full_name" not in lake.scan("silver.dim_customer").columns
    assert not {"currency", "counterparty"} & set(lake.scan("silver.fact_transaction").columns)
    assert pairs(lake.scan("silver.dim_date").select("date_sk")) == [(20240110,), (20240111,)]

    # keys of facts are unique over the days, and every key resolves
    txns = lake.scan("silver.fact_transaction")
    assert txns.select("txn_sk").distinct().count() == txns.count() == txns.where("account_sk > 0").count()
    loans = lake.scan("silver.fact_loan")
    assert loans.select("loan_sk").distinct().count() == loans.count()

    # a second run of a day changes nothing
    tables = ["bronze.transactions", "silver.fact_transaction", "silver.fact_loan", "silver.dim_account",
              "gold.kpi_daily", "gold.deposits_by_segment", "gold.txn_by_channel", "gold.loans_by_status"]
    business = {t: [c for c in lake.scan(t).columns if not c.startswith("_")] for t in tables}
    before = {t: sorted(map(str, lake.scan(t).select(*business[t]).collect())) for t in tables}
    day(spark, lake, D2, manifests=path)
    assert {t: sorted(map(str, lake.scan(t).select(*business[t]).collect())) for t in tables} == before

    manifests = runs.read_manifests(spark, path)
    assert manifests.count() == 3
    assert pairs(runs.manifest_stages(manifests).select("status", "aggregate").distinct()) == [("success", "passed")]
    qa = runs.manifest_qa(manifests)
    assert qa.where("stage like 'bronze:%'").count() == 12 and qa.where("outcome = 'fail'").count() == 0
    actors = {r.actor: r for r in runs.audit_by_actor(manifests).collect()}
    assert actors["extraction"].entries == 3 and actors["extraction"].rows > 0 and actors["validation"].errors == 0


def test_repeated_key_halts_before_silver(spark, lake):
    run = day(spark, lake, D1, spoil=True)
    assert run.status == "failed"
    assert run.stages == {"extract": "failed", "transform": "pending", "aggregate": "pending"}
    assert any("unique[txn_id]: 1 duplicate(s)" in q[2] for q in run.qa)
    assert not lake.exists("silver.fact_transaction")


def test_retry_heals_or_escalates(spark, lake):
    state = {"reads": 0}

    def heal():  # bad at the first read only
        state["reads"] += 1
        return state["reads"] == 1

    run = day(spark, lake, D1, spoil=heal, retry=True)
    assert run.status == "success"
    run = day(spark, lake, D1, spoil=True, retry=True)
    assert run.status == "failed" and run.audit[-1][4] == "escalate"


def test_failure_is_recorded(spark, lake):
    path = scratch(spark, "manifests")
    broken = [bronze.SourceConfig("x", "x", lambda: spark.read.parquet("/nowhere"), "full", "d", "bronze.x")]
    with pytest.raises(Exception):
        runs.run_day(spark, lake, broken, {}, D1, CONTRACTS, salt="s", manifests=path)
    row = runs.read_manifests(spark, path).first()
    assert row.status == "failed" and row.stages["extract"] == "failed" and row.audit[0].outcome == "error"


def test_run_stores_every_unexpected_value(spark, lake):
    df = spark.range(60).select(F.col("id").cast("string").alias("kind"), F.lit(D1).cast("date").alias("d"))
    source = bronze.SourceConfig("x", "x", lambda: df, "full", "d", "bronze.x", (), "x")
    for _ in range(2):  # a second run of a day changes nothing
        run = runs.run_day(spark, lake, [source], {}, D1, {"x": {"allowed_values": {"kind": ["7"]}}}, salt="s")
        assert run.status == "failed" and all(f"'{i}'" in run.qa[0][2] for i in range(60) if i != 7)
        rows = lake.scan("ops.unexpected_values")
        assert pairs(rows.select("source_id", "column", "value", "n")) == sorted(("x", "kind", str(i), 1) for i in range(60) if i != 7)
