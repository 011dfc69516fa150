import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators.star import drop_pii


def one(spark, expr, **values):
    names = list(values)
    schema = ", ".join(f"{n} {t}" for n, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(expr.alias("r")).first().r \
        if names else spark.range(1).select(expr.alias("r")).first().r


def test_token(spark):
    def token(v):
        return one(spark, c.token(F.col("n"), "salt"), n=("string", v))

    assert token("Jane Doe") == token("Jane Doe") != token("John Doe")
    assert len(token("Jane Doe")) == 16 and "Jane" not in token("Jane Doe")
    assert token(None) is None


def test_salt_comes_from_the_session(spark):
    with pytest.raises(ValueError):
        c.pii_salt(spark)


@pytest.mark.parametrize("curr,prior,expected", [(110, 100, 10.0), (100, None, None), (100, 0, None), (100, 3, 3233.33)])
def test_growth(spark, curr, prior, expected):
    got = one(spark, c.growth_pct(F.col("a"), F.col("b")), a=("double", float(curr)),
              b=("double", None if prior is None else float(prior)))
    assert got == expected


@pytest.mark.parametrize("den,expected", [(0, None), (4, 2.5), (3, 3.3333)])
def test_safe_div(spark, den, expected):
    assert one(spark, c.safe_div(F.lit(10), F.col("d")), d=("int", den)) == expected


@pytest.mark.parametrize("cur,expected", [("EUR", "1.00"), ("GBP", "1.17"), ("USD", "0.92"), ("CHF", "1.04"),
                                          ("JPY", "1.00"), (None, "1.00")])
def test_fx(spark, cur, expected):
    got = one(spark, c.to_eur(F.lit(Decimal("100.00")).cast(c.MONEY), F.col("x")), x=("string", cur))
    assert got == Decimal(expected) * 100


@pytest.mark.parametrize("dpd,expected", [(-1, None), (0, "current"), (1, "delinquent"), (89, "delinquent"),
                                          (90, "default"), (10000, "default"), (10001, None), (None, None)])
def test_bucket(spark, dpd, expected):
    assert one(spark, c.loan_bucket(F.col("d")), d=("int", dpd)) == expected


@pytest.mark.parametrize("kind,amount,expected", [("deposit", -5, 5), ("interest", 5, 5), ("fee", 5, -5),
                                                  ("withdrawal", -5, -5), ("payment", 5, -5), ("transfer", -5, -5),
                                                  ("transfer", 5, 5)])
def test_sign(spark, kind, amount, expected):
    got = one(spark, c.signed_amount(F.col("k"), F.col("a")), k=("string", kind), a=("int", amount))
    assert got == expected


def test_missing_values_are_false_flags(spark):
    for flag in (c.is_fee, c.is_interest, c.is_deposit, c.is_loan):
        assert one(spark, flag(F.col("k")), k=("string", None)) is False
    assert one(spark, c.is_npl(F.col("d")), d=("int", None)) is False


def test_date_key(spark):
    day = dt.date(2024, 2, 29)
    assert one(spark, c.date_sk(F.col("d")), d=("date", day)) == 20240229
    assert one(spark, c.sk_to_date(F.col("k")), k=("int", 20240229)) == day


def test_drop_pii(spark):
    df = spark.createDataFrame([(1, "Jane", "1990")], "id int, full_name string, birth_date string")
    out = drop_pii(df, ["full_name", "birth_date"], ["full_name"], "s")
    assert out.columns == ["id", "full_name_token"]
