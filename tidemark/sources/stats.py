"""What a writer knows about its batches, kept as tables: row counts per day, and digests of keys for uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.lake import BATCH, Lake

COUNTS = "ops.row_counts"


def keep_counts(lake: Lake, source: str, day: str, rows: int) -> None:
    """The rows that a source landed for a day; a rerun replaces its own entry."""
    row = lake.spark.range(1, numPartitions=1).select(
        F.lit(source).alias("source_id"), F.lit(day).alias("date"), F.lit(rows).cast("bigint").alias("n")
    )
    lake.write(COUNTS, row, "append", f"{source}:{day}")


def counts(lake: Lake, source: str) -> DataFrame:
    """(date, n) of every day that was landed for a source, one small row each."""
    return lake.scan(COUNTS).where(F.col("source_id") == source).select("date", "n")


def index_name(source: str, column: str) -> str:
    return f"ops.keys_{source}_{column}"


def keep_keys(lake: Lake, source: str, column: str, rows: DataFrame, batch: str) -> None:
    """The digests of the keys of a batch, eight bytes each, in the batch's own folder."""
    digests = rows.select(F.xxhash64(column).alias("digest")).distinct()
    lake.write(index_name(source, column), digests, "append", batch)


def repeats(lake: Lake, source: str, table: str, column: str, batch: str) -> DataFrame:
    """(check, n): rows of a batch that repeat a key of the batch or of any other batch; repeated nulls count too.

    The digests of the other batches are read, never their rows: Spark filters that scan by the batch's own few digests.
    Only the batches in which a digest is met are opened then, to compare the keys themselves.
    """
    landed = lake.scan(table, keep_batch=True)
    own = landed.where(F.col(BATCH) == batch)
    groups = own.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    met: list[str] = []
    if lake.exists(index_name(source, column)):
        index = lake.scan(index_name(source, column), keep_batch=True).where(F.col(BATCH) != batch)
        mine = own.select(F.xxhash64(column).alias("digest")).distinct()
        met = [r[0] for r in index.join(mine, "digest", "left_semi").select(BATCH).distinct().collect()]  # names of batches
    if met:
        old = landed.where(F.col(BATCH).isin(met)).select(F.col(column).alias("_old")).distinct()
        seen = groups.join(old, groups["_k"].eqNullSafe(old["_old"]), "left_semi").select("_k", F.lit(1).alias("_seen"))
        seen = seen.withColumnRenamed("_k", "_o")
        groups = groups.join(seen, groups["_k"].eqNullSafe(seen["_o"]), "left")
    else:
        groups = groups.withColumn("_seen", F.lit(None).cast("int"))
    extra = F.when(F.col("_seen").isNotNull(), F.col("_c")).otherwise(F.col("_c") - 1)
    return groups.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("n")).select(F.lit(f"unique[{column}]").alias("check"), "n")
