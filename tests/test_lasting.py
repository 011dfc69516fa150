"""What has to last over days: keys, versions, facts by day, key index, row counts, rates, growth and bitmaps."""

import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF, pairs
from test_kpi import make_star
from tidemark import fixed
from tidemark.operators import fx, history, slices
from tidemark.operators.keys import Registry, registered
from tidemark.plans import kpi, measures, runs
from tidemark.sources import bronze, stats

DAYS = ["2024-01-10", "2024-01-11", "2024-01-12"]
ACCOUNTS = "account_id long, customer_id long, product_type string, status string, balance decimal(18,2), currency string, snapshot_date date"
POSTINGS = ("txn_id long, account_id long, posting_ts timestamp, amount decimal(18,2), currency string, txn_type string, "
            "channel string, counterparty string")
LOANS = "loan_id long, account_id long, principal_outstanding decimal(18,2), interest_rate decimal(6,1), days_past_due int, status string, snapshot_date date"


class Bank:
    """A bank of a few rows: what each source holds on a day."""

    def __init__(self, spark):
        self.spark, self.accounts = spark, {d: [1, 2, 3] for d in DAYS}
        self.channels = {d: [("atm", False), ("web", True)] for d in DAYS}
        self.postings = [(10 * i + k, k, f"{d} 08:00:00", D(5), "EUR", "interest", "web", "x") for i, d in enumerate(DAYS) for k in (1, 2)]
        self.segment, self.tolerance = {d: "retail" for d in DAYS}, 40

    def sources(self, day):
        spark, on = self.spark, date.fromisoformat(day)
        cfg = bronze.SourceConfig

        def accounts():
            return spark.createDataFrame([(a, a, "savings", "active", D(100), "EUR", on) for a in self.accounts[day]], ACCOUNTS)

        def customers():
            rows = [(a, f"name {a}", self.segment[day] if a == 1 else "sme", "FR", on) for a in self.accounts[day]]
            return spark.createDataFrame(rows, "customer_id long, full_name string, segment string, country string, onboarded_date date")

        def postings():
            rows = spark.createDataFrame(self.postings, POSTINGS.replace("posting_ts timestamp", "posting_ts string"))
            return rows.withColumn("posting_ts", F.to_timestamp("posting_ts"))

        def loans():
            return spark.createDataFrame([(a, a, D(50), D(1), 0, "current", on) for a in self.accounts[day][:1]], LOANS)

        return [
            cfg("accounts", "accounts", accounts, "full", "snapshot_date", "bronze.accounts", (), "accounts"),
            cfg("core_transactions", "transactions", postings, "incremental", "posting_ts", "bronze.transactions", (), "transactions"),
            cfg("customers", "customers", customers, "full", "onboarded_date", "bronze.customers", (), "customers"),
            cfg("loans", "loans", loans, "full", "snapshot_date", "bronze.loans", (), "loans"),
        ]

    def run(self, lake, day, **options):
        lookups = {
            "reference_channels": self.spark.createDataFrame(self.channels[day], "channel string, is_digital boolean"),
            "reference_products": self.spark.createDataFrame([("savings", "Savings")], "product_type string, product_name string"),
        }
        contracts = {
            "accounts": {}, "customers": {}, "loans": {},
            "transactions": {"unique": ["txn_id"], "row_count": {"tolerance_pct": self.tolerance},
                             "allowed_values": {"currency": ["EUR", "USD"]}},
        }
        return runs.run_day(self.spark, lake, self.sources(day), lookups, day, contracts, salt="s", **options)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_three_days_of_coming_and_going(spark, lake):
    bank = Bank(spark)
    bank.accounts = {DAYS[0]: [2, 3, 5], DAYS[1]: [1, 2, 5], DAYS[2]: [1, 2, 3, 5]}  # 3 leaves and returns, 1 comes
    bank.channels[DAYS[1]] = bank.channels[DAYS[2]] = [("app", True), ("atm", False), ("web", True)]
    bank.segment = {DAYS[0]: "retail", DAYS[1]: "retail", DAYS[2]: "private"}
    bank.postings = [(10 * i + k, a, f"{d} 08:00:00", D(5), "EUR", "interest", "web", "x")
                     for i, d in enumerate(DAYS) for k, a in enumerate(bank.accounts[d][:2])]
    columns = ["date_sk", "account_sk"]
    assert bank.run(lake, DAYS[0]).status == "success"
    first = rows(lake.scan("silver.fact_transaction"), *columns, "channel_sk", "txn_sk")
    keys = dict(rows(lake.scan("silver.dim_account"), "account_id", "account_sk"))
    assert keys == {2: 1, 3: 2, 5: 3}
    for d in DAYS[1:]:
        assert bank.run(lake, d).status == "success"
    known = dict(rows(lake.scan("silver.dim_account"), "account_id", "account_sk"))
    assert known == {**keys, 1: 4}
    txns = lake.scan("silver.fact_transaction")
    assert rows(txns.where("date_sk = 20240110"), *columns, "channel_sk", "txn_sk") == first
    assert dict(rows(lake.scan("silver.dim_channel"), "channel", "channel_sk")) == {"atm": 1, "web": 2, "app": 3}
    # the stored star answers for every day, also for the account that was away on the second
    whole = runs.stored_star(lake)
    assert pairs(kpi.txn_by_channel(whole).select("date", "channel", "txn_count")) == [(d, "web", 2) for d in DAYS]
    assert pairs(kpi.deposits_by_segment(whole).groupBy("date").agg(F.sum("deposits_eur"))) == [
        (DAYS[0], 300.0), (DAYS[1], 300.0), (DAYS[2], 400.0)]
    # versions: customer 1 came on the second day and changed on the third
    versions = lake.scan("silver.dim_customer_history").where("customer_id = 1")
    assert rows(versions, "segment", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "is_current") == [
        ("private", DAYS[2], None, True), ("retail", DAYS[1], DAYS[2], False)]
    # the second day comes again, corrected: only its day changes, and the newest state stays
    bank.segment[DAYS[1]] = "corporate"
    before = rows(lake.scan("silver.dim_customer"), "customer_id", "segment", "is_current")
    assert bank.run(lake, DAYS[1]).status == "success"
    assert rows(lake.scan("silver.dim_customer_history").where("customer_id = 1"), "segment",
                F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "is_current") == [
        ("corporate", DAYS[1], DAYS[2], False), ("private", DAYS[2], None, True)]
    assert rows(lake.scan("silver.dim_customer"), "customer_id", "segment", "is_current") == before
    assert rows(lake.scan("silver.fact_transaction").where("date_sk = 20240110"), *columns, "channel_sk", "txn_sk") == first
    # distinct customers of any days and cells from the stored bitmaps
    bits = lake.scan(runs.ACTIVE_BITS)
    assert pairs(measures.count_bits(bits, ["date"])) == [(d, 2) for d in DAYS]
    assert bits.agg(F.count_distinct("date")).first()[0] == 3
    assert measures.count_bits(bits.withColumn("all", F.lit(1)), ["all"]).first().active == 3


def test_gate_reads_its_batch_and_the_index(spark, lake):
    bank = Bank(spark)
    bank.postings[0] = (*bank.postings[0][:4], "XXX", *bank.postings[0][5:])  # one broken row on the first day
    assert bank.run(lake, DAYS[0]).status == "failed"
    bank.postings = [p for p in bank.postings if not p[2].startswith(DAYS[1])]
    bank.postings += [(100 + k, 1, f"{DAYS[1]} 09:00:00", D(1), "EUR", "fee", "web", "x") for k in range(2)]
    second = bank.run(lake, DAYS[1])
    assert second.status == "success"  # the broken row is the first day's
    assert [q[1] for q in second.qa if q[0] == "bronze:core_transactions"] == ["pass"]  # rows as on the day before
    third = bank.run(lake, DAYS[2])
    assert third.status == "success"
    found = lake.scan(runs.UNEXPECTED)
    assert pairs(found.select("source_id", "column", "value", "n")) == [("core_transactions", "currency", "XXX", 1)]
    # a key of the second day turns up again on the third, and rows are fewer than the tolerance allows
    bank.postings = [(100, 1, f"{DAYS[2]} 09:00:00", D(1), "EUR", "fee", "web", "x")]
    again = bank.run(lake, DAYS[2], retry=True)
    text = next(q[2] for q in again.qa if q[0] == "bronze:core_transactions")
    assert again.status == "failed" and "unique[txn_id]: 1 duplicate(s)" in text and "1 rows, 50.0 % from the mean 2.0" in text
    assert [a[4] for a in again.audit if a[0] == "gate"] == ["escalate"]
    # what is read: the digests of other days, and rows of the run's batch and of the days met
    plan = stats.repeats(lake, "core_transactions", "bronze.transactions", "txn_id", f"core_transactions:{DAYS[2]}")
    assert plan._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [") >= 2


def test_day_without_any_rows_gets_its_kpi_row(spark, lake):
    bank = Bank(spark)
    bank.accounts[DAYS[1]], bank.postings, bank.tolerance = [], bank.postings[:2], 100
    assert bank.run(lake, DAYS[0]).status == "success"
    run = bank.run(lake, DAYS[1])
    assert run.stages["aggregate"] == "passed"
    stored = rows(lake.scan("gold.kpi_daily"), "date", "total_deposits_eur", "txn_count", "nim_pct")
    assert [(r[0], r[1], r[2]) for r in stored] == [(DAYS[0], 300.0, 2), (DAYS[1], 0.0, 0)]


def test_facts_are_read_by_day(spark, lake):
    bank = Bank(spark)
    for d in DAYS[:2]:
        bank.run(lake, d)
    star = runs.stored_star(lake)
    for df in (kpi.day_filter(star.fact_transaction, DAYS[0]), runs.stored_star(lake, DAYS[0]).fact_loan):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "(date_sk#" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert df.inputFiles() and df.count() > 0
    plan = measures.evaluate(star, ["total_deposits"], ["segment"])._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan.split("PartitionFilters: [")[1].split("]")[0]  # the last day prunes at run time


def test_gold_gate_says_what_is_out(spark, lake):
    row = {name: 1.0 for name in fixed.GOLD_BOUNDS}
    name, (lo, hi) = next(iter(fixed.GOLD_BOUNDS.items()))
    row[name] = hi + 1.0
    lake.write("gold.kpi_daily", spark.createDataFrame([("2024-01-01", *row.values())], ["date", *row]), "append", "d")
    texts = {r.details for r in runs.gold_gate(lake).collect() if r.outcome == "fail"}
    assert len(texts) == 1 and " OUT OF [" in texts.pop()
    assert all(" in [" in r.details for r in runs.gold_gate(lake).collect() if r.outcome == "pass")


def test_registry(spark, lake):
    book = Registry(lake, "keys.x", "id", "sk")
    assert pairs(book.assign(spark.createDataFrame([("b", 1), ("c", 2), ("b", 3)], "id string, v int"))) == [
        (1, "b", 1), (1, "b", 3), (2, "c", 2)]
    later = spark.createDataFrame([("a", 4), (None, 5), (None, 6), ("c", 7)], "id string, v int")
    assert rows(book.assign(later), "sk", "v") == [(2, 7), (3, 5), (3, 6), (4, 4)]
    assert book.allocate(later) == 0 and book.known().count() == 4
    keys = registered(lake)(spark.createDataFrame([], "id string"), "id", "empty_sk")
    assert keys.columns == ["empty_sk", "id"] and keys.count() == 0


def test_splice_equals_the_log(spark):
    """Snapshots of random days in random order, some twice with a correction, against the log in day order."""
    rng, days = random.Random(6), [date(2024, 1, 1) + timedelta(d) for d in range(6)]
    final, order = {}, days + rng.sample(days, 3)
    rng.shuffle(order)
    dim, seen = None, set()
    for day in order:
        state = {k: rng.choice("xyz") for k in range(8)}
        final[day] = state
        snapshot = spark.createDataFrame(list(state.items()), "k int, s string")
        later = min((d for d in seen if d > day), default=None)
        if dim is None:
            first = snapshot.withColumns({"d": F.lit(day), "r": F.lit(0)})
            dim = history.scd2_history(first, "k", "d", ["s"], "r")
        else:
            dim = history.scd2_splice(dim, snapshot, "k", ["s"], day.isoformat(), later and later.isoformat())
        dim = spark.createDataFrame(dim.collect(), dim.schema)
        seen.add(day)
    log = spark.createDataFrame([(k, d, s, 0) for d, st in final.items() for k, s in st.items()], "k int, d date, s string, r int")
    want = history.scd2_history(log, "k", "d", ["s"], "r")
    assert rows(dim, *want.columns) == rows(want, *want.columns)


def test_rates_are_an_input(spark):
    day = date(2024, 1, 5)
    rates = [("USD", day, D("0.5")), ("USD", date(2024, 1, 8), D("0.25")), ("USD", date(2024, 1, 8), D("0.2")),
             ("EUR", day, D("7")), (None, day, D("1")), ("GBP", day, None)]
    rates = spark.createDataFrame(rates, "currency string, date date, rate decimal(9,4)")
    asked = [(1, "USD", date(2024, 1, 4)), (2, "USD", day), (3, "USD", date(2024, 1, 7)), (4, "USD", date(2024, 1, 30)),
             (5, "EUR", day), (6, "XXX", day), (7, None, day), (8, "USD", None), (9, "GBP", day)]
    df = spark.createDataFrame(asked, "id int, currency string, on date")
    got = dict(pairs(fx.with_rate(df, "currency", "on", rates).select("id", F.col(fx.RATE).cast("double"))))
    assert got == {1: 1.0, 2: 0.5, 3: 0.5, 4: 0.25, 5: 1.0, 6: 1.0, 7: 1.0, 8: 1.0, 9: 1.0}
    fixed_rates = dict(pairs(fx.with_rate(df, "currency", "on").select("id", F.col(fx.RATE).cast("double"))))
    assert fixed_rates[2] == 0.92 and fixed_rates[6] == fixed_rates[7] == 1.0


def test_absent_day_fails(spark):
    daily = spark.createDataFrame([("2024-01-01", 10), ("2024-01-02", 11), ("2024-01-04", 10)], "date string, n long")
    got = {r.date: (r.n, r.outcome, r.trailing_avg) for r in kpi.trailing_counts(daily).collect()}
    assert got["2024-01-03"] == (0, "fail", 10.5) and got["2024-01-04"] == (10, "pass", 10.5)
    assert got["2024-01-01"][1] == "warn" and len(got) == 4


def test_nim_on_days_without_postings(spark):
    star = make_star(spark, [(20240101, 1, 1, D("5"), "interest")], [], [(20240101, 2, D("100"), 0), (20240102, 2, D("100"), 0)])
    assert pairs(kpi.net_interest_margin(star.fact_transaction, star.fact_loan)) == [("2024-01-01", 5.0), ("2024-01-02", 0.0)]


def test_running_sum_of_a_null_key_over_slices(spark):
    df = spark.createDataFrame([(None if i % 2 else "k", i, D(1)) for i in range(4000)], "k string, i int, v decimal(18,2)")
    got = slices.running_sum(df, "k", ["i"], "v", "total", 7)
    assert {tuple(r) for r in got.groupBy("k").agg(F.max("total"), F.count("*")).collect()} == {(None, D(2000), 2000), ("k", D(2000), 2000)}


def test_a_day_of_too_many_rows_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(slices, "DAY_KEYS", 3)
    df = spark.range(5).withColumn("date_sk", F.lit(20240101))
    with pytest.raises(Exception, match="a day of 3 rows"):
        slices.day_key(df, ["id"], "sk").collect()


def test_growth_by_cell(spark):
    star = make_star(
        spark,
        [(20240101, 1, 1, D(5), "fee"), (20240101, 3, 2, D(5), "fee"), (20240103, 1, 1, D(5), "fee")],
        [(20240101, 1, D(100), True), (20240102, 1, D(150), True), (20240103, 3, D(10), True)],
        [(20240101, 2, D(10), 0), (20240103, 2, D(20), 0)],
    )
    got = measures.evaluate(star, ["deposits_growth_pct", "loans_growth_pct", "net_new_customers"], ["date", "segment"])
    assert rows(got, "date", "segment", "deposits_growth_pct", "loans_growth_pct", "net_new_customers") == [
        ("2024-01-01", "retail", None, None, 1), ("2024-01-01", None, None, None, 1),
        ("2024-01-02", "retail", 50.0, None, -1), ("2024-01-02", None, None, None, -1),
        ("2024-01-03", "retail", None, None, 1), ("2024-01-03", None, None, None, 0)]
    with pytest.raises(ValueError):
        measures.evaluate(star, ["net_new_customers"], ["segment"])


@pytest.mark.parametrize("subtotals", ["rollup", "cube"])
def test_subtotals_expand_cells_only(spark, subtotals):
    import __spark_entry__ as entry

    star = entry.star(spark, SF)
    got = measures.evaluate(star, ["active_customers", "transaction_volume"], ["channel", "segment"], subtotals)
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    expands = [i for i, line in enumerate(plan) if "Expand" in line]
    assert expands
    for i in expands:  # the next node below is the aggregate of the cells
        below = next(line for line in plan[i + 1 :] if depth(line) > depth(plan[i]) and "Project" not in line)
        assert "Aggregate" in below
