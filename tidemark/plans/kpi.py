"""Gold: the daily KPIs and marts of any number of days in one job.

Every fact is cut to a few rows per day by a map-side combined aggregate before anything is joined or ordered.
Windows without a partition run on such daily rows only: one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import columns as c
from tidemark.operators import star as s

def _double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def day_filter(facts: DataFrame, as_of: str) -> DataFrame:
    """Facts of one business day; prunes when the fact is stored by date_sk."""
    return facts.where(F.col("date_sk") == int(as_of.replace("-", "")))


# daily measures, still decimal ---------------------------------------------------------------------------


def deposits_daily(balances: DataFrame) -> DataFrame:
    return balances.groupBy("date_sk").agg(c.sum_where(F.col("is_deposit"), F.col("balance_eur")).alias("deposits"))


def loans_daily(loans: DataFrame) -> DataFrame:
    principal = F.col("principal_outstanding_eur")
    return loans.groupBy("date_sk").agg(
        F.coalesce(F.sum(principal), F.lit(0)).alias("loans"),
        c.sum_where(F.col("is_npl"), principal).alias("npl"),
    )


def txns_daily(star: s.Star) -> DataFrame:
    """Additive measures of a day. The facts are combined per (day, channel) before the channel is looked up."""
    amount, key = F.col("amount_eur"), star.channel_key
    small = star.fact_transaction.groupBy("date_sk", key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(amount)).alias("value"),
        c.sum_where(F.col("is_fee"), amount).alias("fee"),
        c.sum_where(F.col("is_interest"), amount).alias("interest"),
    )
    return s.txn_channel(small, star.dim_channel, key).groupBy("date_sk").agg(
        F.sum("n").alias("n"),
        F.sum("value").alias("value"),
        (-F.sum("fee")).alias("fee"),
        F.sum("interest").alias("interest"),
        F.sum(F.when(F.col("is_digital").isNotNull(), F.col("n"))).alias("known"),
        F.sum(F.when(F.col("is_digital"), F.col("n")).when(~F.col("is_digital"), 0)).alias("digital"),
    )


def active_daily(star: s.Star, approximate: bool = False) -> DataFrame:
    """Distinct customers of a day. Only distinct (day, account) pairs are shuffled: two narrow columns, with
    repeats dropped map-side, so a hot account is one pair per day and task."""
    seen = s.txn_customer(star, star.fact_transaction.select("date_sk", star.account_key).distinct())
    count = F.approx_count_distinct if approximate else F.count_distinct
    return seen.groupBy("date_sk").agg(count("customer_sk").alias("active"))


def kpi_base(star: s.Star, days: DataFrame | None = None) -> DataFrame:
    """One row per run day. A run day has a balance or loan snapshot, or is one of ``days`` (date_sk); whatever else is
    missing on it counts as nothing.

    The daily rows of the facts are stacked and folded by day: no join and no further pass.
    """
    stacked = (
        deposits_daily(star.fact_account_balance).withColumn("run_day", F.lit(True))
        .unionByName(loans_daily(star.fact_loan).withColumn("run_day", F.lit(True)), allowMissingColumns=True)
        .unionByName(txns_daily(star), allowMissingColumns=True)
        .unionByName(active_daily(star), allowMissingColumns=True)
    )
    if days is not None:
        stacked = stacked.unionByName(days.select("date_sk", F.lit(True).alias("run_day")), allowMissingColumns=True)
    zero = F.lit(0)
    return (
        stacked.groupBy("date_sk")
        .agg(
            F.max("run_day").alias("run_day"),
            *[F.sum(m).alias(m) for m in ["known", "digital"]],
            *[F.coalesce(F.sum(m), zero).alias(m) for m in
              ["deposits", "loans", "npl", "n", "value", "fee", "interest", "active"]],
        )
        .where("run_day")
        .select(c.iso(c.sk_to_date(F.col("date_sk"))).alias("date"), "*")
    )


def kpi_daily(star: s.Star, prior: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """The daily KPI mart. Growth is against the last earlier run day, whatever the gap.

    ``prior`` is the newest stored KPI row before the days of ``star``, if there is one; ``days`` are run days that get a
    row whatever the facts hold.
    """
    by_day = Window.orderBy("date")
    deposits, loans, active = F.col("deposits"), F.col("loans"), F.col("active")
    npl_rate = c.safe_div(F.col("npl"), loans)
    nim = c.safe_div(F.col("interest"), loans)
    base = kpi_base(star, days)
    if prior is not None:
        before = prior.select(
            "date",
            F.col("total_deposits_eur").cast(c.MONEY).alias("deposits"),
            F.col("net_loans_eur").cast(c.MONEY).alias("loans"),
            F.col("active_customers").alias("active"),
            F.lit(True).alias("_stored"),
        )
        base = base.unionByName(before, allowMissingColumns=True)
    else:
        base = base.withColumn("_stored", F.lit(None).cast("boolean"))
    return base.select(
        "_stored",
        "date",
        deposits.cast("double").alias("total_deposits_eur"),
        c.growth_pct(deposits, F.lag(deposits).over(by_day)).alias("deposits_growth_pct"),
        loans.cast("double").alias("net_loans_eur"),
        c.growth_pct(loans, F.lag(loans).over(by_day)).alias("loans_growth_pct"),
        c.safe_div(loans, deposits).alias("loan_to_deposit_ratio"),
        F.round(nim * 100, 4).alias("nim_pct"),
        F.col("fee").cast("double").alias("fee_income_eur"),
        F.col("n").cast("bigint").alias("txn_count"),
        F.col("value").cast("double").alias("txn_value_eur"),
        F.round(npl_rate * 100, 2).alias("npl_rate_pct"),
        active.cast("bigint").alias("active_customers"),
        (active - F.lag(active).over(by_day)).cast("bigint").alias("net_new_customers"),
        F.round(c.ratio(F.col("digital"), F.col("known")) * 100, 2).alias("digital_channel_mix_pct"),
    ).where(F.col("_stored").isNull()).drop("_stored")


# single measures ----------------------------------------------------------------------------------------


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("date", c.iso(c.sk_to_date(F.col("date_sk"))))


def total_deposits(balances: DataFrame) -> DataFrame:
    return _named(deposits_daily(balances)).select("date", F.col("deposits").cast("double").alias("total_deposits_eur"))


def net_loans(loans: DataFrame) -> DataFrame:
    return _named(loans_daily(loans)).select("date", F.col("loans").cast("double").alias("net_loans_eur"))


def loan_to_deposit(balances: DataFrame, loans: DataFrame) -> DataFrame:
    both = deposits_daily(balances).join(loans_daily(loans), "date_sk", "full_outer")
    return _named(both).select("date", c.safe_div(F.col("loans"), F.col("deposits")).alias("loan_to_deposit_ratio"))


def fee_income(txns: DataFrame) -> DataFrame:
    daily = txns.groupBy("date_sk").agg((-c.sum_where(F.col("is_fee"), F.col("amount_eur"))).alias("fee"))
    return _named(daily).select("date", F.col("fee").cast("double").alias("fee_income_eur"))


def net_interest_margin(txns: DataFrame, loans: DataFrame) -> DataFrame:
    """Net interest over loans for every day with a loan snapshot; a day without postings has no interest.

    The daily rows of both facts are stacked and folded by day.
    """
    amount = F.col("amount_eur")
    flow = txns.groupBy("date_sk").agg(c.sum_where(F.col("is_interest"), amount).alias("interest"))
    stacked = loans_daily(loans).withColumn("snapshot", F.lit(True)).unionByName(flow, allowMissingColumns=True)
    daily = stacked.groupBy("date_sk").agg(
        F.max("snapshot").alias("snapshot"), F.sum("loans").alias("loans"),
        F.coalesce(F.sum("interest"), F.lit(0)).alias("interest"),
    ).where("snapshot")
    nim = c.safe_div(F.col("interest"), F.col("loans"))
    return _named(daily).select("date", F.round(nim * 100, 4).alias("nim_pct"))


def npl_rate(loans: DataFrame) -> DataFrame:
    rate = c.safe_div(F.col("npl"), F.col("loans"))
    return _named(loans_daily(loans)).select("date", F.round(rate * 100, 2).alias("npl_rate_pct"))


def active_customers(star: s.Star, approximate: bool = False) -> DataFrame:
    """Distinct customers per day; the approximate form keeps a sketch per day."""
    return _named(active_daily(star, approximate)).select("date", F.col("active").cast("bigint").alias("active_customers"))


def digital_mix(star: s.Star) -> DataFrame:
    """Share of digital postings; a posting of an unknown channel is left out of the divisor."""
    key = star.channel_key
    small = star.fact_transaction.groupBy("date_sk", key).agg(F.count(F.lit(1)).alias("n"))
    daily = s.txn_channel(small, star.dim_channel, key).groupBy("date_sk").agg(
        F.sum(F.when(F.col("is_digital"), F.col("n")).when(~F.col("is_digital"), 0)).alias("digital"),
        F.sum(F.when(F.col("is_digital").isNotNull(), F.col("n"))).alias("known"),
    )
    mix = F.round(c.ratio(F.col("digital"), F.col("known")) * 100, 2)
    return _named(daily).select("date", mix.alias("digital_channel_mix_pct"))


def txn_volume_value(txns: DataFrame) -> DataFrame:
    daily = txns.groupBy("date_sk").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum(F.abs("amount_eur")).cast("double").alias("txn_value_eur")
    )
    return _named(daily).select("date", "txn_count", "txn_value_eur")


# marts ---------------------------------------------------------------------------------------------------


def deposits_by_segment(star: s.Star) -> DataFrame:
    """Deposits per day and segment; balances without a segment drop out.

    A balance is one row per account and day, so no account can be hot here.
    """
    deposits = star.fact_account_balance.where("is_deposit").select("date_sk", star.account_key, "balance_eur")
    rows = s.balance_segment(star, deposits).where(F.col("segment").isNotNull())
    mart = _named(rows.groupBy("date_sk", "segment").agg(F.sum("balance_eur").alias("deposits_eur")))
    return _double(mart, "deposits_eur").select("date", "segment", "deposits_eur")


def txn_by_channel(star: s.Star) -> DataFrame:
    key = star.channel_key
    small = star.fact_transaction.groupBy("date_sk", key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs("amount_eur")).alias("value")
    )
    rows = s.txn_channel(small, star.dim_channel, key).where(
        F.col("channel").isNotNull() & F.col("is_digital").isNotNull()
    )
    mart = rows.groupBy("date_sk", "channel", "is_digital").agg(
        F.sum("n").alias("txn_count"), F.sum("value").cast("double").alias("txn_value_eur")
    )
    return _named(mart).select("date", "channel", "is_digital", "txn_count", "txn_value_eur")


def loans_by_status(loans: DataFrame) -> DataFrame:
    status = c.loan_bucket(F.col("days_past_due"))
    rows = loans.withColumn("status", status).where(F.col("status").isNotNull())
    mart = rows.groupBy("date_sk", "status").agg(
        F.sum("principal_outstanding_eur").cast("double").alias("principal_outstanding_eur")
    )
    return _named(mart).select("date", "status", "principal_outstanding_eur")


def segment_growth(star: s.Star) -> DataFrame:
    """Deposits per segment with growth against the segment's last earlier day."""
    w = Window.partitionBy("segment").orderBy("date")
    return deposits_by_segment(star).withColumn(
        "growth_pct", c.growth_pct(F.col("deposits_eur"), F.lag("deposits_eur").over(w))
    )


def npl_by_product(star: s.Star) -> DataFrame:
    """Outstanding and non-performing principal per day, status and product of the account."""
    key, principal = star.account_key, F.col("principal_outstanding_eur")
    loans = star.fact_loan.select("date_sk", key, "days_past_due", "is_npl", principal)
    rows = (
        loans.join(star.owners("product_type"), key, "left")
        .withColumn("status", c.loan_bucket(F.col("days_past_due")))
        .where(F.col("status").isNotNull() & F.col("product_type").isNotNull())
    )
    mart = rows.groupBy("date_sk", "status", "product_type").agg(
        F.sum(principal).cast("double").alias("principal_outstanding_eur"),
        c.sum_where(F.col("is_npl"), principal).cast("double").alias("npl_eur"),
    )
    return _named(mart).select("date", "status", "product_type", "principal_outstanding_eur", "npl_eur")


def txn_net_flow(star: s.Star) -> DataFrame:
    """Credits minus debits per account and day."""
    amount, key = F.col("amount_eur"), star.account_key
    flow = star.fact_transaction.groupBy(key, "date_sk").agg(
        c.sum_where(amount > 0, amount).alias("credits"),
        c.sum_where(amount < 0, -amount).alias("debits"),
    )
    out = flow.withColumn("net_flow_eur", F.col("credits") - F.col("debits"))
    if key != "account_sk":
        out = out.join(star.owners("account_sk"), key, "left")
    return _double(_named(out), "credits", "debits", "net_flow_eur").select(
        "account_sk", "date", "credits", "debits", "net_flow_eur"
    )


def activity_by_source(txns: DataFrame) -> DataFrame:
    """Volume and value per day and business source, by the type of the posting."""
    kind = F.col("txn_type")
    source = (
        F.when(kind == "withdrawal", "trades").when(kind == "interest", "loans").when(kind == "deposit", "deposits")
        .when(kind == "fee", "cards").when(kind == "payment", "payments").when(kind == "transfer", "transfers")
    )
    mart = (
        txns.withColumn("source", source).where(F.col("source").isNotNull()).groupBy("date_sk", "source")
        .agg(F.count(F.lit(1)).alias("volume"), F.sum(F.abs("amount_eur")).cast("double").alias("value_eur"))
    )
    return _named(mart).select("date", "source", "volume", "value_eur")


def _telemetry(transactions: DataFrame) -> DataFrame:
    """Processing telemetry of postings: ``k`` of the JSON properties read as milliseconds; under 5 is a failure."""
    ms = F.from_json("props", "k int").getField("k")
    return transactions.select(
        F.date_format("posting_ts", "yyyy-MM-dd").alias("date"), "channel", ms.alias("ms"), (ms < 5).alias("failed")
    )


def _pct(cond: Column) -> Column:
    return F.round(F.avg(cond.cast("double")) * 100, 2)


def ops_by_channel(transactions: DataFrame) -> DataFrame:
    return (
        _telemetry(transactions).where(F.col("channel").isNotNull()).groupBy("date", "channel")
        .agg(
            F.count(F.lit(1)).alias("volume"),
            _pct(~F.col("failed")).alias("uptime_pct"),
            F.round(F.avg("ms"), 2).alias("avg_processing_ms"),
        )
    )


def ops_processing_daily(transactions: DataFrame) -> DataFrame:
    return (
        _telemetry(transactions).groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("txn_processed"),
            _pct(~F.col("failed")).alias("stp_rate_pct"),
            F.count_if("failed").alias("exceptions"),
            F.round(F.avg("ms"), 2).alias("avg_processing_ms"),
            _pct(F.col("ms") <= 90).alias("sla_adherence_pct"),
        )
    )


def by_department(staff: DataFrame, as_of: str) -> DataFrame:
    """Headcount and cost per department with cost per head and share of the total cost.

    ``staff`` has ``department`` and ``cost``. The window runs over one row per department.
    """
    groups = staff.groupBy("department").agg(
        F.count(F.lit(1)).alias("headcount"), F.coalesce(F.sum("cost"), F.lit(0)).alias("cost")
    )
    total = F.sum("cost").over(Window.partitionBy())
    return groups.select(
        F.lit(as_of).alias("date"),
        "department",
        "headcount",
        F.col("cost").cast("double").alias("payroll_cost_eur"),
        F.round(c.ratio(F.col("cost"), F.col("headcount")), 2).alias("cost_per_head_eur"),
        F.round(c.ratio(F.col("cost"), total) * 100, 2).alias("share_pct"),
    )


# trends over the daily mart ------------------------------------------------------------------------------


def growth_calendar_day(kpi: DataFrame, value: str) -> DataFrame:
    """Growth against exactly one calendar day before; null when that day has no row. Not rounded."""
    ordinal = F.datediff(F.col("date").cast("date"), F.lit("1970-01-01").cast("date"))
    w = Window.orderBy("_day").rangeBetween(-1, -1)
    return (
        kpi.withColumn("_day", ordinal)
        .withColumn("_prior", F.first(value).over(w))
        .select("date", value, (F.try_divide(F.col(value) - F.col("_prior"), F.col("_prior")) * 100).alias("growth_pct"))
    )


def history_7(kpi: DataFrame, columns: list[str], days: int = 7) -> DataFrame:
    """Per day, the rows of that day and the days before it, oldest first."""
    w = Window.orderBy("date").rowsBetween(1 - days, 0)
    return kpi.select("date", F.collect_list(F.struct("date", *columns)).over(w).alias("history"))


def latest_row(df: DataFrame, order: str = "date") -> DataFrame:
    return df.orderBy(F.desc(order)).limit(1)


def last_of_day(df: DataFrame, day: str, order: list[str]) -> DataFrame:
    """The last row of each day, as an aggregate, so a large day combines map-side."""
    rest = [x for x in df.columns if x != day and x not in order]
    best = df.groupBy(day).agg(F.max(F.struct(*order, *rest)).alias("_b"))
    return best.select(day, *[F.col(f"_b.{x}").alias(x) for x in df.columns if x != day])


def dense_days(daily: DataFrame, day: str = "date") -> DataFrame:
    """``daily`` (one row per day) with a row for every calendar day from its first to its last."""
    on = F.col(day).cast("date")
    span = daily.agg(F.min(on).alias("lo"), F.max(on).alias("hi")).where("lo IS NOT NULL")
    spine = span.select(F.explode(F.sequence("lo", "hi")).alias("_day"))
    kept = daily.withColumn("_on", on).drop(day)
    out = spine.join(kept, F.col("_day") == F.col("_on"), "left").drop("_on")
    back = F.col("_day") if dict(daily.dtypes)[day] == "date" else c.iso(F.col("_day"))
    return out.withColumn("_day", back).withColumnRenamed("_day", day)


def trailing_counts(daily: DataFrame, tolerance_pct: float = 40, warn_pct: float = 20, days: int = 7) -> DataFrame:
    """(date, n) on the calendar against the mean of the ``days`` before: outside the tolerance fails, near it warns.

    A calendar day without a row has n = 0 and so fails; it does not pull down the mean of the days after it.
    """
    dense = dense_days(daily).withColumn("n", F.coalesce("n", F.lit(0)))
    before = F.avg(F.when(F.col("n") > 0, F.col("n"))).over(Window.orderBy("date").rowsBetween(-days, -1))
    dev = F.abs(F.try_divide(F.col("n") - F.col("trailing_avg"), F.col("trailing_avg")) * 100)
    outcome = (
        F.when(F.col("trailing_avg").isNull(), "warn")
        .when(F.col("deviation_pct") > tolerance_pct, "fail")
        .when(F.col("deviation_pct") > warn_pct, "warn")
        .otherwise("pass")
    )
    return (
        dense.withColumn("trailing_avg", before)
        .withColumn("deviation_pct", F.round(dev, 2))
        .withColumn("outcome", outcome)
    )


def trailing_row_count(rows: DataFrame, day: str, tolerance_pct: float = 40, warn_pct: float = 20, days: int = 7):
    """Rows of every calendar day against the mean of the days before it; see :func:`trailing_counts`."""
    daily = rows.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return trailing_counts(daily, tolerance_pct, warn_pct, days)


def kpi_long(kpi: DataFrame, columns: list[str] = fixed.KPI_COLUMNS) -> DataFrame:
    """KPIs as rows: (date, kpi, value)."""
    wide = kpi.select("date", *[F.col(x).cast("double").alias(x) for x in columns])
    return wide.unpivot(["date"], columns, "kpi", "value")


def kpi_transpose(kpi: DataFrame, columns: list[str] = fixed.KPI_COLUMNS) -> DataFrame:
    """KPIs as rows and dates as columns."""
    return kpi_long(kpi, columns).groupBy("kpi").pivot("date").agg(F.first("value"))


def kpi_swing(kpi: DataFrame, threshold_pct: float) -> DataFrame:
    """Day-over-day change of every KPI, with a warning beyond the threshold."""
    w = Window.partitionBy("kpi").orderBy("date")
    change = c.growth_pct(F.col("value"), F.lag("value").over(w))
    flat = [x for x in fixed.KPI_COLUMNS if not x.endswith("growth_pct") and x != "net_new_customers"]
    return (
        kpi_long(kpi, flat)
        .withColumn("swing_pct", change)
        .withColumn("outcome", F.when(F.abs("swing_pct") > threshold_pct, "warn").otherwise("pass"))
    )
