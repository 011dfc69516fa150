"""The driver's tables in the role of the bank's sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import columns as c
from tidemark.session import literal_rows

SNAPSHOT = "2024-01-30"

LINES_CONTRACT = {
    "required_columns": ["line_key", "quantity", "ship_date", "tax"],
    "not_null": ["line_key", "quantity", "ship_date"],
    "unique": ["line_key"],
    "allowed_values": {"l_returnflag": ["A", "N"], "l_linestatus": ["F", "O"]},
    "ranges": {"quantity": {"min": 1, "max": 45}, "discount": {"min": 0, "max": 0.05}, "price": {"min": 0}},
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(index: Column, options: dict[int, str], default: str | None = None) -> Column:
    out = None
    for key, value in options.items():
        out = F.when(index == key, value) if out is None else out.when(index == key, value)
    return out.otherwise(default) if default else out


def customers(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    cust = table(spark, sf, "customer")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("segment"),
        "country",
        F.date_add(F.lit("2015-01-01").cast("date"), (F.col("c_custkey") % 3000).cast("int")).alias("onboarded_date"),
    )


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        key.alias("account_id"),
        key.alias("customer_id"),
        _pick(key % 4, {0: "current", 1: "savings", 2: "deposit", 3: "loan"}).alias("product_type"),
        _pick(key % 6, {4: "dormant", 5: "closed"}, "active").alias("status"),
        F.col("c_acctbal").cast(c.MONEY).alias("balance"),
        _pick(nation % 6, {2: "GBP", 3: "USD", 4: "CHF", 5: "JPY"}, "EUR").alias("currency"),
        F.lit(SNAPSHOT).cast("date").alias("snapshot_date"),
    )


def loans(spark: SparkSession, sf: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        key.alias("loan_id"),
        F.col("o_custkey").alias("account_id"),
        c.money(F.col("o_totalprice").cast(c.MONEY) * F.lit("0.001").cast("decimal(4,3)")).alias(
            "principal_outstanding"
        ),
        (F.lit("2.5").cast("decimal(6,1)") + (key % 71).cast("decimal(4,0)") * F.lit("0.1").cast("decimal(2,1)"))
        .cast("decimal(6,1)")
        .alias("interest_rate"),
        F.when(status == "P", 1 + key % 89).when(status == "O", 90 + key % 271).otherwise(0).cast("int").alias(
            "days_past_due"
        ),
        F.when(status == "P", "delinquent").when(status == "O", "default").otherwise("current").alias("status"),
        F.lit(SNAPSHOT).cast("date").alias("snapshot_date"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """events as postings; the sign of a transfer follows the parity of event_id // 6."""
    return transactions_from(table(spark, sf, "events"))


def transactions_from(events: DataFrame) -> DataFrame:
    key = F.col("event_id")
    kind = _pick(
        key % 6, {0: "payment", 1: "transfer", 2: "fee", 3: "interest", 4: "withdrawal", 5: "deposit"}
    )
    channel = F.col("event_type")
    value = F.col("value").cast(c.MONEY)
    directed = F.when(F.floor(key / 6) % 2 == 0, value).otherwise(-value)
    return events.select(
        key.alias("txn_id"),
        F.col("user_id").alias("account_id"),
        F.col("ts").cast("timestamp").alias("posting_ts"),
        c.signed_amount(kind, directed).cast(c.MONEY).alias("amount"),
        _pick(key % 22, {19: "GBP", 20: "USD", 21: "CHF"}, "EUR").alias("currency"),
        kind.alias("txn_type"),
        F.when(channel == "click", "mobile")
        .when(channel == "view", "web")
        .when(channel == "purchase", "card")
        .when(channel == "signup", "branch")
        .when(channel == "error", "atm")
        .alias("channel"),
        F.concat(F.lit("Party "), (key % 997).cast("string")).alias("counterparty"),
        F.col("props"),
    )


def _per_day(df: DataFrame, spark: SparkSession, sf: str, value: str, slope: str) -> DataFrame:
    """The table as it stood on each day of the events; the amount drifts linearly with the day.

    The days and their factors are one small array, worked out once.
    """
    span = table(spark, sf, "events").agg(F.min("ts").cast("date").alias("lo"), F.max("ts").cast("date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    factor = F.lit(1).cast(c.RATE) + F.lit(slope).cast(c.RATE) * F.dayofmonth("day").cast("decimal(4,0)")
    calendar = days.agg(F.collect_list(F.struct("day", factor.alias("factor"))).alias("calendar"))
    return (
        df.drop("snapshot_date")
        .withColumn("_on", F.explode(calendar.scalar()))
        .withColumns({"snapshot_date": F.col("_on.day"), value: c.money(F.col(value) * F.col("_on.factor"))})
        .drop("_on")
    )


def account_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return _per_day(accounts(spark, sf), spark, sf, "balance", "0.0015")


def loan_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return _per_day(loans(spark, sf), spark, sf, "principal_outstanding", "0.0008")


def customer_states(spark: SparkSession, sf: str) -> DataFrame:
    """orders as a changing attribute of a customer; several states may share a day."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("as_of"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("priority"),
    )


def dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as a dirty source: the line key repeats."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_key"),
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast(c.MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(c.MONEY).alias("price"),
        F.col("l_discount").cast(c.MONEY).alias("discount"),
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """What users ask for: every user turn of the conversations."""
    return (
        table(spark, sf, "conversations")
        .where(F.col("role") == "user")
        .select("conv_id", "turn", F.col("text").alias("request"))
    )


def channels(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, fixed.CHANNELS, "channel string, is_digital boolean")


def products(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, fixed.PRODUCTS, "product_type string, product_name string")


def branches(spark: SparkSession) -> DataFrame:
    rows = [(f"BR{i:03d}", city) for i, city in enumerate(fixed.BRANCH_CITIES, start=1)]
    return literal_rows(spark, rows, "branch_id string, city string")
