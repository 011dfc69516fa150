"""Logical tables ``layer.name`` kept as batches: scan, overwrite, idempotent batch replace, SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

BATCH = "_batch"
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        layer, dot, name = table.partition(".")
        if not dot:
            raise ValueError(f"table name must be 'layer.name', got {table!r}")
        return f"{self.root}/{layer}/{name}"

    def scan(self, table: str, keep_batch: bool = False) -> DataFrame:
        """All batches of a table, united by column name. A filter on the batch prunes folders.

        The batch is read as text, as it was written. Only bronze takes what arrives, so only there are the
        file footers merged; silver and gold have the shape that the code gives them.
        """
        path = self.path(table)
        merged = self.spark.read.option("mergeSchema", table.startswith("bronze.")).parquet(path).schema
        fields = [T.StructField(BATCH, T.StringType()) if f.name == BATCH else f for f in merged]
        df = self.spark.read.schema(T.StructType(fields)).parquet(path)
        return df if keep_batch else df.drop(BATCH)

    def exists(self, table: str) -> bool:
        try:
            self.spark.read.parquet(self.path(table))
        except AnalysisException:
            return False
        return True

    def row_count(self, table: str) -> int:
        return self.scan(table).count() if self.exists(table) else 0

    def write(
        self,
        table: str,
        df: DataFrame,
        mode: str = "append",
        batch: str | Column = "default",
        watch: Observation | None = None,
        *metrics: Column,
    ) -> int:
        """Write batches and return the rows written.

        ``overwrite`` drops the table first. ``append`` replaces only its own batch, also by no rows, so the
        same call twice leaves the table as after the first. ``batch`` may be a column: then one job writes
        every batch that has rows, rebalanced so that a small day is one file and a large day is many tasks.
        ``watch`` then sees ``metrics`` over the rows written.
        """
        if mode not in ("append", "overwrite"):
            raise ValueError(f"mode must be 'append' or 'overwrite', got {mode!r}")
        seen, rows = Observation(), F.count(F.lit(1)).alias("rows")
        if isinstance(batch, str) and mode == "append":
            df.observe(seen, rows).write.mode("overwrite").parquet(self._folder(table, batch))
            return seen.get["rows"]
        out = df.withColumn(BATCH, F.lit(batch) if isinstance(batch, str) else batch)
        if not isinstance(batch, str):
            out = out.hint("rebalance", F.col(BATCH))
        out = out.observe(seen, rows)  # on top, so that an exchange without rows does not take the count with it
        out = out.observe(watch, *metrics) if watch else out
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if mode == "overwrite" else "dynamic")
            .partitionBy(BATCH)
            .parquet(self.path(table))
        )
        rows = seen.get["rows"]
        if rows == 0 and isinstance(batch, str):  # an empty table keeps its columns
            df.limit(0).write.mode("overwrite").parquet(self._folder(table, batch))
        return rows

    def write_days(self, table: str, df: DataFrame, column: str, day: int) -> int:
        """Write rows in folders by their day key ``column`` and return how many; every day with rows is replaced.

        ``day`` is replaced also where it has none. A filter on the column then reads the folders of its days only.
        """
        seen = Observation()
        today = F.count_if(F.col(column) == day).alias("today")
        out = df.hint("rebalance", F.col(column)).observe(seen, today, F.count(F.lit(1)).alias("rows"))
        (
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(column).parquet(self.path(table))
        )
        found = seen.get
        if not found["today"]:  # the folder keeps the columns
            df.limit(0).drop(column).write.mode("overwrite").parquet(f"{self.path(table)}/{column}={day}")
        return found["rows"]

    def _folder(self, table: str, batch: str) -> str:
        """Folder of one batch, escaped as Spark escapes partition values."""
        return f"{self.path(table)}/{BATCH}={''.join(f'%{ord(x):02X}' if x in ESCAPED else x for x in batch)}"

    def sql(self, text: str, tables: list[str]) -> DataFrame:
        """Run SQL over lake tables; ``silver.dim_date`` is seen as ``silver_dim_date``."""
        for table in tables:
            self.scan(table).createOrReplaceTempView(table.replace(".", "_"))
        return self.spark.sql(text)


def merge_batch(existing: DataFrame, new: DataFrame, batch: str) -> DataFrame:
    """Existing rows without the batch, plus its new rows."""
    return existing.where(~F.col(BATCH).eqNullSafe(batch)).unionByName(
        new.withColumn(BATCH, F.lit(batch)), allowMissingColumns=True
    )


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """Stack batches by column name; a column that a batch lacks is null there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


FORMATS = ("parquet", "orc", "csv", "json")


def read_source(
    spark: SparkSession, connector: str, path: str | None = None, schema=None, **options: str
) -> DataFrame:
    """Read a source by the connector that its registry entry names: a file format, or jdbc by its options."""
    if connector not in (*FORMATS, "jdbc"):
        raise NotImplementedError(f"connector {connector!r} is not available")
    reader = spark.read.format(connector).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)
