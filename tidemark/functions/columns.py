"""Scalar rules of the silver layer as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"
SALT_KEY = "spark.tidemark.pii.salt"


def money(col: Column) -> Column:
    """Two decimals; the cast rounds half away from zero."""
    return col.cast(MONEY)


def fx_rate(currency: Column, rates: dict[str, str] = fixed.FX_RATES) -> Column:
    """EUR per unit; an unknown or missing currency counts as EUR."""
    pairs = [F.lit(v).cast(RATE) if i else F.lit(v) for kv in rates.items() for i, v in enumerate(kv)]
    return F.coalesce(F.element_at(F.create_map(*pairs), currency), F.lit(1).cast(RATE))


def to_eur(amount: Column, currency: Column) -> Column:
    return money(amount * fx_rate(currency))


def pii_salt(spark: SparkSession) -> str:
    salt = spark.conf.get(SALT_KEY, None)
    if not salt:
        raise ValueError(f"set {SALT_KEY}")
    return salt


def token(value: Column, salt: str) -> Column:
    """One-way token of a personal value; null stays null."""
    return F.substring(F.sha2(F.concat(F.lit(salt + ":"), value.cast("string")), 256), 1, 16)


def date_sk(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def sk_to_date(sk: Column) -> Column:
    return F.to_date(sk.cast("string"), "yyyyMMdd")


def iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def is_true(cond: Column) -> Column:
    """A comparison with null counts as false."""
    return F.coalesce(cond, F.lit(False))


def is_fee(txn_type: Column) -> Column:
    return is_true(txn_type == "fee")


def is_interest(txn_type: Column) -> Column:
    return is_true(txn_type == "interest")


def is_deposit(product_type: Column) -> Column:
    return is_true(product_type.isin(fixed.DEPOSIT_PRODUCTS))


def is_loan(product_type: Column) -> Column:
    return is_true(product_type == fixed.LOAN_PRODUCT)


def is_npl(days_past_due: Column) -> Column:
    return is_true(days_past_due >= fixed.NPL_DAYS)


def loan_bucket(days_past_due: Column) -> Column:
    """(-1,0] current, (0,89] delinquent, (89,10000] default; null outside."""
    d = days_past_due
    return (
        F.when((d > -1) & (d <= 0), "current")
        .when((d > 0) & (d <= 89), "delinquent")
        .when((d > 89) & (d <= 10000), "default")
    )


def signed_amount(txn_type: Column, amount: Column) -> Column:
    """Credits positive, debits negative; a transfer keeps its sign."""
    return (
        F.when(txn_type.isin("deposit", "interest"), F.abs(amount))
        .when(txn_type.isin("fee", "withdrawal", "payment"), -F.abs(amount))
        .otherwise(amount)
    )


def ratio(num: Column, den: Column) -> Column:
    """num / den in doubles; null when the divisor is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_div(num: Column, den: Column) -> Column:
    return F.round(ratio(num, den), 4)


def growth_pct(curr: Column, prior: Column) -> Column:
    c, p = curr.cast("double"), prior.cast("double")
    return F.round(F.try_divide(c - p, p) * 100, 2)


def sum_where(cond: Column, value: Column) -> Column:
    """Conditional sum; the sum of nothing is zero."""
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0).cast(MONEY))
