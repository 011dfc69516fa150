"""Profiles of whole tables: frequencies, ranges, shares, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Frequencies of several columns from one scan; missing values are not counted."""
    long = df.select(*[F.col(x).cast("string").alias(x) for x in columns]).unpivot([], columns, "column", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").count().withColumnRenamed("count", "n")


def numeric_profile(df: DataFrame, column: str) -> DataFrame:
    """Least, greatest and mean value; the mean of decimals is taken from the exact sum."""
    mean = F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))
    return df.agg(
        F.min(column).cast("double").alias("min"), F.max(column).cast("double").alias("max"), mean.alias("mean")
    )


def share_of(df: DataFrame, **conditions: Column) -> DataFrame:
    """Share of rows in percent for each condition; a null condition counts as not met."""
    return df.agg(
        *[
            (F.try_divide(F.count_if(cond).cast("double"), F.count(F.lit(1)).cast("double")) * 100).alias(name)
            for name, cond in conditions.items()
        ]
    )


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, business columns and lineage columns per table."""
    out = None
    for name, df in tables.items():
        lineage = sum(x.startswith("_") for x in df.columns)
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"),
            "rows",
            F.lit(len(df.columns) - lineage).alias("business_columns"),
            F.lit(lineage).alias("lineage_columns"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def sort_limit(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows by an order; end it with a unique key, so that ties cannot change the answer."""
    return df.orderBy(*order).limit(n)
