"""Daily exchange rates as an input: the last rate of a currency up to a day, and the fixed rates without any."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import columns as c

RATE = "_rate"


def filled(rates: DataFrame) -> DataFrame:
    """(currency, valid_from, valid_to, rate): rates (currency, date, rate) as spans; gaps take the rate before them.

    Of several rates of a day the greatest counts; null rates, days and currencies are left out.
    """
    usable = rates.where(F.col("currency").isNotNull() & F.col("date").isNotNull() & F.col("rate").isNotNull())
    daily = usable.groupBy("currency", F.col("date").cast("date").alias("valid_from")).agg(F.max(F.col("rate").cast(c.RATE)).alias("rate"))
    until = F.lead("valid_from").over(Window.partitionBy("currency").orderBy("valid_from"))
    return daily.select("currency", "valid_from", until.alias("valid_to"), "rate")


def with_rate(df: DataFrame, currency: str, day: str, rates: DataFrame | None = None) -> DataFrame:
    """``df`` with EUR per unit of its currency on its day.

    Without ``rates`` the fixed ones hold for every day. With them a row takes the last rate up to its day; the base
    currency, an unknown one, and a day before the first rate count as EUR. The rates meet the distinct (currency, day)
    pairs of the rows, and only those few meet the rows, so the size of the facts does not matter.
    """
    if rates is None:
        return df.withColumn(RATE, c.fx_rate(F.col(currency)))
    on = F.to_date(F.col(day))
    asked = df.select(F.col(currency).alias("_currency"), on.alias("_on")).distinct()
    spans = filled(rates)
    held = (spans.currency == asked["_currency"]) & (spans.valid_from <= asked["_on"])
    held &= spans.valid_to.isNull() | (asked["_on"] < spans.valid_to)
    found = asked.join(spans, held).select("_currency", "_on", F.col("rate").alias(RATE))
    out = df.withColumn("_day", on)
    out = out.join(found, (out[currency] == found["_currency"]) & (out["_day"] == found["_on"]), "left")
    rate = F.when(F.col(currency) == fixed.BASE_CURRENCY, F.lit(1)).otherwise(F.coalesce(F.col(RATE), F.lit(1)))
    return out.withColumn(RATE, rate.cast(c.RATE)).drop("_currency", "_on", "_day")
