
from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from oracle import sql as oracle  # noqa: E402
from tidemark import fixed  # noqa: E402
from tidemark.functions import columns as c  # noqa: E402
from tidemark.operators import fx, history, keys, profile, quality, slices  # noqa: E402
from tidemark.operators import star as st  # noqa: E402
from tidemark.plans import kpi, measures, reports, runs  # noqa: E402
from tidemark.session import materialise, scratch  # noqa: E402
from tidemark.sources import bank, bronze, lake  # noqa: E402
from tidemark.streaming import ingest  # noqa: E402

CHECK_SALT = "check-salt"  # not a secret: tokens here are compared with the oracle
AS_OF = "2024-01-30"
Query = Callable[[SparkSession, str], DataFrame]

DAILY_CONTRACT = {
    **fixed.CONTRACTS["transactions"],
    "unique": ["txn_id"],
    "ranges": {"amount": {"min": -150, "max": 150}},
}
_STARS: dict[tuple, st.Star] = {}
_GOLD: dict[tuple, dict[str, DataFrame]] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, as the oracle gives them."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            col = c.iso(col).alias(f.name)
        out.append(col)
    return df.select(*out)


def _key(spark: SparkSession, sf: str) -> tuple:
    return spark.sparkContext.applicationId, sf


def star(spark: SparkSession, sf: str) -> st.Star:
    """The star over all days; its dimensions are stored once per session, its facts are lazy."""
    key = _key(spark, sf)
    if key not in _STARS:
        _STARS[key] = st.build(
            customers=bank.customers(spark, sf),
            accounts=bank.accounts(spark, sf),
            account_snapshots=bank.account_snapshots(spark, sf),
            loan_snapshots=bank.loan_snapshots(spark, sf),
            transactions=bank.transactions(spark, sf),
            channels=bank.channels(spark),
            products=bank.products(spark),
            salt=CHECK_SALT,
            as_of=AS_OF,
        )
    return _STARS[key]


def gold(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """Gold marts over all days (all, or the named ones), stored once per session as a nightly run leaves them."""
    s, txns = star(spark, sf), bank.transactions(spark, sf)
    marts = {
        "gold.kpi_daily": lambda: kpi.kpi_daily(s),
        "gold.deposits_by_segment": lambda: kpi.deposits_by_segment(s),
        "gold.txn_by_channel": lambda: kpi.txn_by_channel(s),
        "gold.loans_by_status": lambda: kpi.loans_by_status(s.fact_loan),
        "gold.activity_by_source": lambda: kpi.activity_by_source(s.fact_transaction),
        "gold.ops_by_channel": lambda: kpi.ops_by_channel(txns),
        "gold.ops_processing_daily": lambda: kpi.ops_processing_daily(txns),
        "gold.hr_by_department": lambda: kpi.by_department(_staff(spark, sf), AS_OF),
    }
    stored = _GOLD.setdefault(_key(spark, sf), {})
    for name in names or marts:
        if name not in stored:
            stored[name] = materialise(marts[name](), name)
    return {name: stored[name] for name in names or marts}


def _staff(spark: SparkSession, sf: str) -> DataFrame:
    nation = bank.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("department"))
    sup = bank.table(spark, sf, "supplier")
    return sup.join(nation, sup.s_nationkey == nation.n_nationkey).select(
        "department", F.abs(F.col("s_acctbal").cast(c.MONEY)).alias("cost")
    )


def _lake(spark: SparkSession) -> lake.Lake:
    return lake.Lake(spark, scratch(spark, "lake"))


def _sources(spark: SparkSession, sf: str) -> list[bronze.SourceConfig]:
    cfg = bronze.SourceConfig
    return [
        cfg("accounts", "accounts", lambda: bank.accounts(spark, sf), "full", "snapshot_date",
            "bronze.accounts", (), "accounts"),
        cfg("core_transactions", "transactions", lambda: bank.transactions(spark, sf), "incremental",
            "posting_ts", "bronze.transactions", ("counterparty",), "transactions"),
        cfg("customers", "customers", lambda: bank.customers(spark, sf), "full", "onboarded_date",
            "bronze.customers", ("full_name",), "customers"),
        cfg("loans", "loans", lambda: bank.loans(spark, sf), "full", "snapshot_date",
            "bronze.loans", (), "loans"),
    ]


def _span(spark: SparkSession, sf: str) -> tuple[str, str]:
    row = bank.table(spark, sf, "events").agg(
        c.iso(F.min("ts")).alias("lo"), c.iso(F.max("ts")).alias("hi")
    ).first()
    return row.lo, row.hi


# scans, sources, sinks -----------------------------------------------------------------------------------


def scan_table(spark, sf):
    """Two batches of different shape read as one table."""
    box, rows = _lake(spark), bank.customers(spark, sf)
    early = F.col("segment").isin("AUTOMOBILE", "BUILDING")
    box.write("bronze.customers", rows.where(early).drop("country"), "append", "b1")
    box.write("bronze.customers", rows.where(~early), "append", "b2")
    return box.scan("bronze.customers").select("customer_id", "segment", "country")


def write_overwrite(spark, sf):
    box, rows = _lake(spark), bank.loans(spark, sf)
    box.write("bronze.loans", rows, "append", "b1")
    box.write("bronze.loans", rows, "overwrite", "b2")
    return box.scan("bronze.loans", keep_batch=True).select("loan_id", "principal_outstanding", "_batch")


def write_batch_replace(spark, sf):
    """All days in one job, twice; the second run changes nothing."""
    box, rows = _lake(spark), bank.transactions(spark, sf)
    day = F.concat(F.lit("core_transactions:"), F.date_format("posting_ts", "yyyy-MM-dd"))
    for _ in range(2):
        box.write("bronze.transactions", rows, "append", day)
    return box.scan("bronze.transactions", keep_batch=True).select("txn_id", "amount", "_batch")


def merge_batch(spark, sf):
    rows = bank.transactions(spark, sf).select("txn_id", "amount", F.date_format("posting_ts", "yyyy-MM-dd").alias("_batch"))
    new = rows.where(F.col("_batch") == AS_OF).select("txn_id", (F.col("amount") * 2).cast(c.MONEY).alias("amount"))
    return lake.merge_batch(rows, new, AS_OF)


def _landed(spark, sf) -> lake.Lake:
    box = _lake(spark)
    lookups = {
        "reference_products": bank.products(spark),
        "reference_branches": bank.branches(spark),
        "reference_channels": bank.channels(spark),
    }
    bronze.land(box, _sources(spark, sf), lookups, "run-1", *_span(spark, sf))
    return box


LANDED = ["accounts", "customers", "loans", "transactions", "reference_products", "reference_branches",
          "reference_channels"]


def table_row_count(spark, sf):
    box, out = _landed(spark, sf), None
    for name in LANDED:
        row = box.scan(f"bronze.{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


def land_bronze(spark, sf):
    """Rows per landed batch, read back from the tables."""
    box, out = _landed(spark, sf), None
    for name in LANDED[:4]:
        rows = box.scan(f"bronze.{name}").groupBy("_source_system", "_batch_id", "_run_id").agg(
            F.count(F.lit(1)).alias("rows")
        )
        out = rows if out is None else out.unionByName(rows)
    return out.withColumnsRenamed({"_source_system": "source", "_batch_id": "batch_id", "_run_id": "run_id"})


def land_since(spark, sf):
    """Postings landed up to a mark and then from it on; the days of the lookback are met twice and written once."""
    box, (_, last) = _lake(spark), _span(spark, sf)
    cfg = next(x for x in _sources(spark, sf) if x.source_id == "core_transactions")
    for run, day in enumerate(("2024-01-15", last, last)):
        bronze.land_since(box, cfg, f"run-{run}", day)
    return box.scan("bronze.transactions", keep_batch=True).select("txn_id", "amount", "_batch", F.col("_run_id").alias("run"))


def add_lineage(spark, sf):
    rows = bronze.add_lineage(
        bank.table(spark, sf, "orders"), "orders", f"orders:{AS_OF}", "run-1", F.col("_metadata.file_path")
    )
    return rows.select(
        "o_orderkey", F.col("_source_system").alias("source"), F.col("_batch_id").alias("batch_id"),
        F.col("_run_id").alias("run_id"), F.col("_source_file").contains("orders").alias("has_file"),
        F.col("_ingested_at").isNotNull().alias("has_time"),
    )


def incremental_window(spark, sf):
    day = bronze.incremental_window(bank.table(spark, sf, "events"), "ts", "2024-01-15")
    return bank.transactions_from(day).select("txn_id", "account_id", "amount")


def source_connectors(spark, sf):
    """orders written in every file format and read back by connector name."""
    rows, out = bank.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), None
    for name in lake.FORMATS:
        path = scratch(spark, f"source-{name}")
        rows.write.format(name).save(path)
        back = lake.read_source(spark, name, path, rows.schema)
        one = back.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("o_totalprice").cast(c.MONEY)).cast("double").alias("total"),
            F.max("o_orderkey").alias("last_key"),
        ).select(F.lit(name).alias("connector"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def sql_query(spark, sf):
    box = _lake(spark)
    box.write("bronze.accounts", bank.accounts(spark, sf), "overwrite", "b")
    box.write("bronze.loans", bank.loans(spark, sf), "overwrite", "b")
    return box.sql(
        """SELECT a.product_type, count(*) AS loans, CAST(sum(l.principal_outstanding) AS DOUBLE) AS principal
           FROM bronze_loans l JOIN bronze_accounts a ON l.account_id = a.account_id GROUP BY a.product_type""",
        ["bronze.accounts", "bronze.loans"],
    )


# projections ---------------------------------------------------------------------------------------------


def fx_normalize(spark, sf):
    rows = bank.transactions(spark, sf)
    return rows.select("txn_id", "currency", "amount", c.to_eur(F.col("amount"), F.col("currency")).alias("amount_eur"))


def tokenize_pii(spark, sf):
    rows = bank.customers(spark, sf)
    return rows.select("customer_id", c.token(F.col("full_name"), CHECK_SALT).alias("customer_token"))


def drop_pii(spark, sf):
    return st.drop_pii(bank.transactions(spark, sf).drop("props"), ["counterparty"], ["counterparty"], CHECK_SALT).drop(
        "posting_ts"
    )


def date_sk(spark, sf):
    return bank.transactions(spark, sf).select("txn_id", c.date_sk(F.col("posting_ts")).alias("date_sk"))


def txn_flags(spark, sf):
    kind = F.col("txn_type")
    return bank.transactions(spark, sf).select(
        "txn_id", c.is_fee(kind).alias("is_fee"), c.is_interest(kind).alias("is_interest")
    )


def balance_flags(spark, sf):
    product = F.col("product_type")
    return bank.accounts(spark, sf).select(
        "account_id", c.is_deposit(product).alias("is_deposit"), c.is_loan(product).alias("is_loan")
    )


def npl_flag(spark, sf):
    return bank.loans(spark, sf).select("loan_id", c.is_npl(F.col("days_past_due")).alias("is_npl"))


def loan_bucket(spark, sf):
    return bank.loans(spark, sf).select("loan_id", c.loan_bucket(F.col("days_past_due")).alias("status"))


def signed_amount(spark, sf):
    rows = bank.transactions(spark, sf)
    return rows.select("txn_id", "txn_type", c.signed_amount(F.col("txn_type"), F.abs("amount")).alias("amount"))


# joins over facts ----------------------------------------------------------------------------------------


def dim_account_customer(spark, sf):
    s = star(spark, sf)
    return st.dim_account_customer(bank.accounts(spark, sf), s.dim_customer).select(
        "account_id", "customer_sk", "product_type", "status"
    )


def keyed_star(spark: SparkSession, sf: str) -> st.Star:
    return st.keyed(star(spark, sf))


def fact_txn_keys(spark, sf):
    return keyed_star(spark, sf).fact_transaction


def fact_balance_keys(spark, sf):
    return keyed_star(spark, sf).fact_account_balance


def fact_loan_keys(spark, sf):
    s = star(spark, sf)
    return st.fact_account_keys(st.loan_values(bank.loans(spark, sf)), s.dim_account)


def txn_customer(spark, sf):
    s = keyed_star(spark, sf)
    return st.txn_customer(s, s.fact_transaction).select("txn_id", "account_sk", "customer_sk", "date_sk")


def txn_channel(spark, sf):
    s = keyed_star(spark, sf)
    return st.txn_channel(s.fact_transaction, s.dim_channel).select("txn_id", "channel", "is_digital", "amount_eur")


def balance_segment(spark, sf):
    s = keyed_star(spark, sf)
    return st.balance_segment(s, s.fact_account_balance).select(
        "account_sk", "date_sk", "customer_sk", "segment", "balance_eur"
    )


def orphan_keys(spark, sf):
    """Account keys of postings and of loans without a customer, and line orders without an order."""
    accounts, cust = bank.accounts(spark, sf), bank.customers(spark, sf)
    events, orders = bank.table(spark, sf, "events"), bank.table(spark, sf, "orders")
    pairs = [
        ("accounts", accounts, cust, "customer_id", "customer_id"),
        ("transactions", bank.transactions(spark, sf), accounts, "account_id", "account_id"),
        ("loans", bank.loans(spark, sf), accounts, "account_id", "account_id"),
        ("customers without postings", cust, events, "customer_id", "user_id"),
        ("orders without lines", orders, bank.table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey"),
    ]
    out = None
    for name, child, parent, key, parent_key in pairs:
        row = st.orphan_keys(child, parent, key, parent_key).agg(F.count(F.lit(1)).alias("orphans"))
        row = row.select(F.lit(name).alias("relation"), "orphans")
        out = row if out is None else out.unionByName(row)
    return out


def _first_orders(spark, sf):
    """Every customer with the key of a first order; a customer without orders has a gap there."""
    orders = bank.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("order_sk"))
    return bank.table(spark, sf, "customer").select("c_custkey", "c_name").join(orders, "c_custkey", "left")


def unresolved_fk(spark, sf):
    """Customers whose key finds no order."""
    return st.unresolved_fk(_first_orders(spark, sf), "order_sk")


def stable_keys(spark, sf):
    """Customers by the month of their orders, one run a month of the last year: they come, leave and come back.

    Every run looks its customers up and gives keys to new ones; what is returned is the key that each run used.
    """
    box, month = _lake(spark), F.date_format("o_orderdate", "yyyy-MM")
    orders = bank.table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id"), month.alias("month")).distinct()
    runs_of = [r[0] for r in orders.select("month").distinct().orderBy(F.desc("month")).limit(6).collect()]
    book, out = keys.Registry(box, "keys.customer_sk", "customer_id", "customer_sk"), None
    book.allocate(orders.where(F.col("month") < min(runs_of)))
    for run in sorted(runs_of):
        used = materialise(book.assign(orders.where(F.col("month") == run)), "used-keys")
        out = used if out is None else out.unionByName(used)
    return out.select("month", "customer_id", "customer_sk")


def fx_daily(spark, sf):
    """Postings at daily rates. The rate of a currency is quoted on the days on which it has a posting of over 100, by the
    largest of them; between quotes the last one holds."""
    rows = bank.transactions(spark, sf)
    quoted = rows.where((F.col("currency") != "EUR") & (F.abs("amount") > 100))
    rates = quoted.groupBy("currency", F.to_date("posting_ts").alias("date")).agg((F.max(F.abs("amount")) / 100).alias("rate"))
    rated = fx.with_rate(rows, "currency", "posting_ts", rates)
    eur = c.money(F.col("amount") * F.col(fx.RATE))
    return rated.select("txn_id", "currency", F.col(fx.RATE).cast("double").alias("rate"), eur.alias("amount_eur"))


LATE, AFTER = "1996-07-01", "1996-07-02"


def scd2_splice(spark, sf):
    """The order priorities of customers as versions, and a snapshot of their segments that comes late."""
    late = bank.customers(spark, sf).select("customer_id", F.col("segment").alias("priority"))
    out = history.scd2_splice(_versions(spark, sf), late, "customer_id", ["priority"], LATE, AFTER)
    return out


def kpi_pivot(spark, sf):
    """KPIs as rows and the days of one month as columns."""
    rows = kpi.kpi_transpose(gold(spark, sf, "gold.kpi_daily")["gold.kpi_daily"])
    return rows.withColumnsRenamed({x: f"d{x.replace('-', '')}" for x in rows.columns if x != "kpi"})


def active_bits(spark, sf):
    """Distinct customers of all days by segment, and in total, from the stored bitmaps of the days."""
    bits = materialise(runs.active_bits(star(spark, sf)), "active-bits")
    return measures.count_bits(bits, ["segment"], "rollup")


def _versions(spark, sf):
    return history.scd2_history(bank.customer_states(spark, sf), "customer_id", "as_of", ["priority"], "seq")


def scd2_asof(spark, sf):
    """Every line with the priority that its customer had on the ship date."""
    orders = bank.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    lines = bank.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey",
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )
    facts = lines.join(orders, "o_orderkey")
    return history.scd2_asof(facts, _versions(spark, sf), "customer_id", "ship_date", ["priority"])


# windows -------------------------------------------------------------------------------------------------


def growth_pct(spark, sf):
    return kpi.kpi_daily(star(spark, sf)).select("date", "deposits_growth_pct", "loans_growth_pct")


def net_new_customers(spark, sf):
    return kpi.kpi_daily(star(spark, sf)).select("date", "active_customers", "net_new_customers")


def growth_calendar_day(spark, sf):
    return kpi.growth_calendar_day(kpi.total_deposits(star(spark, sf).fact_account_balance), "total_deposits_eur")


def history_7(spark, sf):
    rows = kpi.history_7(gold(spark, sf, "gold.kpi_daily")["gold.kpi_daily"], ["txn_count"])
    return rows.select(
        "date",
        F.size("history").cast("bigint").alias("days"),
        F.array_join(F.col("history.date"), ",").alias("dates"),
        F.array_join(F.col("history.txn_count").cast("array<string>"), ",").alias("txn_counts"),
    )


def latest_row(spark, sf):
    return kpi.latest_row(kpi.txn_volume_value(star(spark, sf).fact_transaction))


def first_row_per_day(spark, sf):
    rows = bank.transactions(spark, sf).select(
        F.date_format("posting_ts", "yyyy-MM-dd").alias("date"), "posting_ts", "txn_id", "account_id", "amount"
    )
    return kpi.last_of_day(rows, "date", ["posting_ts", "txn_id"]).drop("posting_ts")


def surrogate_key(spark, sf):
    return slices.dense_key(star(spark, sf).fact_transaction, ["txn_id"], "txn_sk").select("txn_sk", "txn_id")


def dedup_latest(spark, sf):
    return history.dedup_latest(bank.dirty_lines(spark, sf), ["line_key"], ["ship_date"])


def running_balance(spark, sf):
    rows = bank.transactions(spark, sf).select(
        "txn_id", "account_id", "posting_ts", c.to_eur(F.col("amount"), F.col("currency")).alias("amount_eur")
    )
    out = slices.running_sum(rows, "account_id", ["posting_ts", "txn_id"], "amount_eur", "balance_eur")
    return out.drop("posting_ts")


def trailing_row_count(spark, sf):
    rows = bank.transactions(spark, sf).select(F.to_date("posting_ts").alias("day"))
    return kpi.trailing_row_count(rows, "day")


def kpi_swing(spark, sf):
    return kpi.kpi_swing(gold(spark, sf, "gold.kpi_daily")["gold.kpi_daily"], 10)


def sort_limit(spark, sf):
    rows = bank.loans(spark, sf).select("loan_id", "principal_outstanding")
    return profile.sort_limit(rows, [F.desc("principal_outstanding"), F.col("loan_id")], 20)


# quality -------------------------------------------------------------------------------------------------


def _counts(df: DataFrame) -> DataFrame:
    return df.select("check", F.col("n").cast("bigint").alias("n"))


def _only(kind: str) -> dict:
    return {kind: bank.LINES_CONTRACT[kind]}


def dq_not_null(spark, sf):
    """Missing values, on a table with gaps: customers without an order."""
    return _counts(quality.count_broken(_first_orders(spark, sf), {"not_null": ["c_name", "order_sk"]}))


def dq_unique(spark, sf):
    return _counts(quality.count_repeats(bank.dirty_lines(spark, sf), "line_key"))


def dq_allowed_values(spark, sf):
    return quality.unexpected_values(bank.dirty_lines(spark, sf), bank.LINES_CONTRACT)


def dq_range(spark, sf):
    return _counts(quality.count_broken(bank.dirty_lines(spark, sf), _only("ranges")))


def dq_row_count(spark, sf):
    return kpi.trailing_row_count(bank.dirty_lines(spark, sf), "ship_date")


def _all_checks(spark, sf):
    out = None
    frames = {
        "accounts": bank.accounts(spark, sf), "customers": bank.customers(spark, sf),
        "loans": bank.loans(spark, sf), "transactions": bank.transactions(spark, sf),
    }
    for name, df in frames.items():
        rows = quality.validate(df, fixed.CONTRACTS[name]).select(F.lit(name).alias("source"), "*")
        out = rows if out is None else out.unionByName(rows)
    dirty = quality.validate(bank.dirty_lines(spark, sf), bank.LINES_CONTRACT)
    return out.unionByName(dirty.select(F.lit("lines").alias("source"), "*"))


def dq_validate(spark, sf):
    return _all_checks(spark, sf).drop("ord")


def dq_gate(spark, sf):
    checks = _all_checks(spark, sf)
    per_source = quality.gate(checks, ["source"])
    return per_source.unionByName(quality.gate(per_source).select(F.lit("all").alias("source"), "outcome"))


def dq_silver(spark, sf):
    return quality.silver_checks(keyed_star(spark, sf))


def dq_gold_bounds(spark, sf):
    newest = kpi.latest_row(gold(spark, sf, "gold.kpi_daily")["gold.kpi_daily"])
    return quality.gold_checks(newest)


def dq_quarantine(spark, sf):
    _, bad = quality.quarantine(bank.dirty_lines(spark, sf), bank.LINES_CONTRACT)
    return bad.select("line_key", "l_partkey", "quantity", "discount", "l_returnflag",
                      F.array_join("failed", ";").alias("failed"))


def gate_decision(spark, sf):
    """Gates of every day of postings; the odd days ask for a retry, at the first and at the second attempt."""
    checks = runs.manifest_qa(_manifests(spark, sf))
    gates = quality.gate(checks, ["run_id"])
    odd = F.substring("run_id", -2, 2).cast("int") % 2 == 1
    tries = F.explode(F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.lit(n).cast("bigint").alias("retries"))
        for layer in ("bronze", "gold") for n in (0, 1)
    ]))
    asked = gates.select("run_id", "outcome", F.when(odd, " Retry ").alias("requested"), tries.alias("_t"))
    return quality.gate_decision(asked.select("run_id", "outcome", "requested", "_t.*")).drop("requested")


# reports and runs ----------------------------------------------------------------------------------------


def report_resolve(spark, sf):
    return reports.resolve_all(gold(spark, sf), "loans").select(
        "template", F.col("visual").cast("bigint").alias("visual"), "type", "series", "x", "value"
    )


def route_requests(spark, sf):
    return reports.route_requests(bank.requests(spark, sf)).drop("request").withColumn(
        "score", F.col("score").cast("bigint")
    )


BRIEF = ["txn_count", "active_customers"]


def briefing_context(spark, sf):
    qa = runs.manifest_qa(_manifests(spark, sf)).withColumn("date", F.substring("run_id", 5, 10))
    return reports.briefing_context(gold(spark, sf, "gold.kpi_daily")["gold.kpi_daily"], qa, BRIEF)


def lake_profile(spark, sf):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations"]
    out = profile.table_profile({n: bank.table(spark, sf, n) for n in names})
    return out.withColumns({n: F.col(n).cast("bigint") for n in ["rows", "business_columns", "lineage_columns"]})


def value_counts(spark, sf):
    return profile.value_counts(bank.transactions(spark, sf), ["currency", "txn_type", "channel"])


def share_of(spark, sf):
    eur = profile.share_of(bank.transactions(spark, sf), share=F.col("currency") == "EUR")
    npl = profile.share_of(bank.loans(spark, sf), share=F.col("days_past_due") >= fixed.NPL_DAYS)
    return eur.select(F.lit("EUR postings").alias("what"), "share").unionByName(
        npl.select(F.lit("loans 90 days past due").alias("what"), "share")
    )


def json_extract(spark, sf):
    return bank.table(spark, sf, "events").select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


def _manifests(spark, sf):
    """Manifests of all days, through their JSON form."""
    records = runs.daily_manifests(bank.transactions(spark, sf), DAILY_CONTRACT)
    stored = records.select(F.to_json(F.struct(*records.columns)).alias("doc"))
    return stored.select(F.from_json("doc", runs.MANIFEST).alias("m")).select("m.*")


def manifest_qa(spark, sf):
    return runs.manifest_qa(_manifests(spark, sf)).drop("checked_at")


def manifest_audit(spark, sf):
    return runs.audit_by_actor(_manifests(spark, sf))


def manifest_stages(spark, sf):
    return runs.manifest_stages(_manifests(spark, sf))


# streams -------------------------------------------------------------------------------------------------


def _stream(spark, sf):
    return bank.transactions_from(ingest.file_stream(spark, f"{sf}/events.parquet"))


def stream_bronze(spark, sf):
    out = ingest.land_stream(_stream(spark, sf), scratch(spark, "stream-bronze"), "txn_id", "posting_ts")
    return out.select("txn_id", "account_id", "amount", F.col("_day").cast("string").alias("day"))


def _totals() -> dict:
    return {"txn_count": F.count(F.lit(1)), "txn_value": F.sum(F.abs("amount"))}


def stream_daily_txn(spark, sf):
    out = ingest.daily_stream(
        _stream(spark, sf), scratch(spark, "stream-daily"), ["channel"], _totals(), "posting_ts"
    )
    return out


def stream_closed_days(spark, sf):
    return ingest.closed_days(
        _stream(spark, sf), scratch(spark, "stream-closed"), ["channel"], _totals(), "txn_id", "posting_ts", "2 days"
    )


def stream_dedup(spark, sf):
    """Every posting is delivered twice and counts once."""
    twice = _stream(spark, sf).unionByName(_stream(spark, sf))
    out = ingest.land_stream(twice, scratch(spark, "stream-dedup"), "txn_id", "posting_ts")
    return out.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))


# contract ------------------------------------------------------------------------------------------------


def _queries() -> dict[str, Query]:
    def on_star(work: Callable[[st.Star], DataFrame]) -> Query:
        return lambda spark, sf: work(star(spark, sf))

    def on_gold(work: Callable[[DataFrame], DataFrame], mart: str) -> Query:
        return lambda spark, sf: work(gold(spark, sf, mart)[mart])

    return {
        "scan_table": scan_table,
        "write_overwrite": write_overwrite,
        "write_batch_replace": write_batch_replace,
        "merge_batch": merge_batch,
        "table_row_count": table_row_count,
        "land_bronze": land_bronze,
        "land_since": land_since,
        "add_lineage": add_lineage,
        "incremental_window": incremental_window,
        "source_connectors": source_connectors,
        "sql_query": sql_query,
        "fx_normalize": fx_normalize,
        "tokenize_pii": tokenize_pii,
        "drop_pii": drop_pii,
        "date_sk": date_sk,
        "txn_flags": txn_flags,
        "balance_flags": balance_flags,
        "npl_flag": npl_flag,
        "loan_bucket": loan_bucket,
        "signed_amount": signed_amount,
        "day_filter": on_star(lambda s: kpi.day_filter(st.keyed(s).fact_transaction, "2024-01-15")),
        "latest_date_rows": on_gold(reports.latest_date_rows, "gold.loans_by_status"),
        "source_filter": on_star(
            lambda s: reports.source_filter(kpi.activity_by_source(s.fact_transaction), "loans")
        ),
        "dim_account_customer": dim_account_customer,
        "fact_txn_keys": fact_txn_keys,
        "fact_balance_keys": fact_balance_keys,
        "fact_loan_keys": fact_loan_keys,
        "txn_customer": txn_customer,
        "txn_channel": txn_channel,
        "balance_segment": balance_segment,
        "orphan_keys": orphan_keys,
        "unresolved_fk": unresolved_fk,
        "scd2_asof": scd2_asof,
        "scd2_splice": scd2_splice,
        "stable_keys": stable_keys,
        "fx_daily": fx_daily,
        "kpi_pivot": kpi_pivot,
        "active_bits": active_bits,
        "total_deposits": on_star(lambda s: kpi.total_deposits(s.fact_account_balance)),
        "net_loans": on_star(lambda s: kpi.net_loans(s.fact_loan)),
        "loan_to_deposit": on_star(lambda s: kpi.loan_to_deposit(s.fact_account_balance, s.fact_loan)),
        "fee_income": on_star(lambda s: kpi.fee_income(s.fact_transaction)),
        "nim": on_star(lambda s: kpi.net_interest_margin(s.fact_transaction, s.fact_loan)),
        "npl_rate": on_star(lambda s: kpi.npl_rate(s.fact_loan)),
        "active_customers": on_star(kpi.active_customers),
        "digital_mix": on_star(kpi.digital_mix),
        "txn_volume_value": on_star(lambda s: kpi.txn_volume_value(s.fact_transaction)),
        "kpi_daily": on_star(kpi.kpi_daily),
        "deposits_by_segment": on_star(kpi.deposits_by_segment),
        "txn_by_channel": on_star(kpi.txn_by_channel),
        "loans_by_status": on_star(lambda s: kpi.loans_by_status(s.fact_loan)),
        "value_counts": value_counts,
        "numeric_profile": lambda spark, sf: profile.numeric_profile(bank.transactions(spark, sf), "amount"),
        "share_of": share_of,
        "sum_by_dim": on_gold(lambda m: reports.sum_by_dim(m, "channel", "txn_value_eur"), "gold.txn_by_channel"),
        "measures_by_dims": on_star(
            lambda s: measures.evaluate(
                s,
                ["total_deposits", "net_loans", "loan_to_deposit_ratio", "net_interest_margin_pct", "fee_income",
                 "transaction_volume", "transaction_value", "npl_rate_pct", "active_customers",
                 "digital_channel_mix_pct"],
                ["date", "segment"],
            )
        ),
        "measures_by_product": on_star(
            lambda s: measures.evaluate(
                s, ["total_deposits", "net_loans", "npl_rate_pct", "transaction_value"], ["product_type"]
            )
        ),
        "measures_by_channel": on_star(
            lambda s: measures.evaluate(
                s, ["transaction_volume", "fee_income", "net_loans", "net_interest_margin_pct"], ["channel"]
            )
        ),
        "measures_rollup": on_star(
            lambda s: measures.evaluate(
                s, ["total_deposits", "net_loans", "active_customers", "transaction_volume"],
                ["country", "segment"], "rollup",
            )
        ),
        "measures_cube": on_star(
            lambda s: measures.evaluate(
                s, ["transaction_volume", "transaction_value", "active_customers"], ["channel", "segment"], "cube"
            )
        ),
        "growth_by_segment": on_star(
            lambda s: measures.evaluate(
                s, ["total_deposits", "deposits_growth_pct", "loans_growth_pct", "active_customers", "net_new_customers"],
                ["date", "segment"],
            )
        ),
        "growth_by_channel": on_star(
            lambda s: measures.evaluate(
                s, ["deposits_growth_pct", "loans_growth_pct", "net_new_customers"], ["date", "channel"]
            )
        ),
        "txn_net_flow": on_star(kpi.txn_net_flow),
        "segment_growth": on_star(kpi.segment_growth),
        "npl_by_product": on_star(kpi.npl_by_product),
        "activity_by_source": on_star(lambda s: kpi.activity_by_source(s.fact_transaction)),
        "ops_by_channel": lambda spark, sf: kpi.ops_by_channel(bank.transactions(spark, sf)),
        "ops_processing_daily": lambda spark, sf: kpi.ops_processing_daily(bank.transactions(spark, sf)),
        "by_department": lambda spark, sf: kpi.by_department(_staff(spark, sf), AS_OF),
        "growth_pct": growth_pct,
        "net_new_customers": net_new_customers,
        "growth_calendar_day": growth_calendar_day,
        "history_7": history_7,
        "latest_row": latest_row,
        "first_row_per_day": first_row_per_day,
        "surrogate_key": surrogate_key,
        "dedup_latest": dedup_latest,
        "running_balance": running_balance,
        "scd2_history": _versions,
        "trailing_row_count": trailing_row_count,
        "kpi_swing": kpi_swing,
        "sort_limit": sort_limit,
        "stream_bronze": stream_bronze,
        "stream_daily_txn": stream_daily_txn,
        "stream_closed_days": stream_closed_days,
        "stream_dedup": stream_dedup,
        "dim_date": on_star(lambda s: s.dim_date),
        "union_batches": union_batches,
        "unexpected_values": lambda spark, sf: quality.unexpected_values(
            bank.customers(spark, sf), fixed.CONTRACTS["customers"]
        ),
        "kpi_transpose": on_gold(kpi.kpi_long, "gold.kpi_daily"),
        "json_extract": json_extract,
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_allowed_values": dq_allowed_values,
        "dq_range": dq_range,
        "dq_row_count": dq_row_count,
        "dq_validate": dq_validate,
        "dq_gate": dq_gate,
        "dq_silver": dq_silver,
        "dq_gold_bounds": dq_gold_bounds,
        "dq_quarantine": dq_quarantine,
        "gate_decision": gate_decision,
        "report_kpi_cards": on_gold(
            lambda m: reports.cards(m, fixed.TEMPLATES[0]["visuals"][0][2] + ["no_such_field"]), "gold.kpi_daily"
        ),
        "report_line": on_gold(
            lambda m: reports.line(m, "date", ["total_deposits_eur", "net_loans_eur", "no_such"]), "gold.kpi_daily"
        ),
        "report_bar": on_gold(
            lambda m: reports.sum_by_dim(m, "segment", "deposits_eur"), "gold.deposits_by_segment"
        ),
        "report_resolve": report_resolve,
        "route_requests": route_requests,
        "dashboard_context": lambda spark, sf: reports.dashboard_series(
            gold(spark, sf, "gold.kpi_daily", "gold.deposits_by_segment", "gold.txn_by_channel", "gold.loans_by_status")
        ),
        "briefing_context": briefing_context,
        "lake_profile": lake_profile,
        "manifest_qa": manifest_qa,
        "manifest_audit": manifest_audit,
        "manifest_stages": manifest_stages,
    }


def union_batches(spark, sf):
    """Sources of different shape stacked by column name."""
    accounts = bank.accounts(spark, sf).select("account_id", "product_type", "balance")
    loans = bank.loans(spark, sf).select("account_id", "loan_id", "principal_outstanding")
    return lake.union_batches([accounts, loans])


def entry(spark: SparkSession) -> DataFrame:
    """The daily KPI mart over all days of sf0.001."""
    return _plain(kpi.kpi_daily(star(spark, "/root/testdata/sf0.001")))


def library_queries() -> dict[str, Query]:
    """Queries of the library itself, without those of the training-data subpackage."""

    def plain(query: Query) -> Query:
        return lambda spark, sf_dir: _plain(query(spark, str(sf_dir).rstrip("/")))

    return {name: plain(query) for name, query in _queries().items()}


def _training() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and statements of the training-data subpackage; nothing where it or its pipeline is not installed."""
    out, sql = {}, {}
    try:
        from tidemark.llm import queries as training

        out, sql = training.queries(), training.oracle_sql()
        import corpus_pipeline

        out["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ModuleNotFoundError as missing:
        if missing.name not in ("tidemark.llm", "tidemark.llm.queries", "corpus_pipeline"):
            raise
    return out, sql


def queries() -> dict[str, Query]:
    return library_queries() | _training()[0]


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | _training()[1]
