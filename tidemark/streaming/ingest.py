"""The daily batch as streams: landing, exact daily totals, and totals of closed days.

A table brings its own ledger of the epochs and files it has taken: the stream's checkpoint, in a folder beside the table.
So a further call goes on where the last one ended, and nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY, EPOCH = "_day", "_epoch"


def ledger(path: str) -> str:
    """The checkpoint of the stream that writes a table."""
    return f"{path.rstrip('/')}-ledger"


def file_stream(spark: SparkSession, path: str, schema=None, **options: str) -> DataFrame:
    """New files of a folder (or the one file that ``path`` is), each delivered once.

    As a pattern the path may be a file: a plain path has to be a folder for a stream. ``options`` such as
    ``maxFilesPerTrigger`` cut a large backlog into epochs.
    """
    path = path.rstrip("/")
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")


def _replace(df: DataFrame, path: str, *parts: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _stored(spark: SparkSession, path: str, days: list, epoch: int) -> DataFrame | None:
    """Rows of the touched days from earlier epochs, by folder; None when there are none yet."""
    try:
        df = spark.read.parquet(path)
    except Exception as exc:  # no table before the first epoch
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise
    return df.where(F.col(DAY).isin(days) & (F.col(EPOCH) != epoch))


def fresh_rows(batch: DataFrame, epoch: int, path: str, key: str, ts: str) -> DataFrame:
    """Rows of a micro-batch whose key is new within its day, however late they come."""
    rows = batch.withColumns({DAY: F.to_date(ts), EPOCH: F.lit(epoch)}).dropDuplicates([DAY, key])
    days = [r[0] for r in rows.select(DAY).distinct().collect()]  # calendar days of one micro-batch
    known = _stored(batch.sparkSession, path, days, epoch)
    if known is None:
        return rows
    return rows.join(known.select(DAY, key), [DAY, key], "left_anti")


def land_stream(stream: DataFrame, path: str, key: str, ts: str, checkpoint: str | None = None) -> DataFrame:
    """Land all available files in a table kept by day and epoch, each key once per day.

    An epoch that is replayed rewrites its own folders only; a late row opens a new folder of its day and
    leaves the others as they are.
    """
    spark = stream.sparkSession

    def land(batch: DataFrame, epoch: int) -> None:
        _replace(fresh_rows(batch, epoch, path, key, ts).hint("rebalance", F.col(DAY)), path, DAY, EPOCH)

    _drain(stream.writeStream.foreachBatch(land), checkpoint or ledger(path))
    return spark.read.parquet(path)


def daily_stream(
    stream: DataFrame, path: str, by: list[str], aggs: dict, ts: str, checkpoint: str | None = None
) -> DataFrame:
    """Daily totals that add up, kept as one partial result per epoch: exact for rows of any lateness.

    ``aggs`` maps a name to a count or sum; the result sums the partials of the epochs.
    """
    spark = stream.sparkSession

    def partial(batch: DataFrame, epoch: int) -> None:
        daily = batch.groupBy(F.to_date(ts).alias("date"), *by).agg(*[a.alias(n) for n, a in aggs.items()])
        _replace(daily.withColumn(EPOCH, F.lit(epoch)).hint("rebalance", F.col(EPOCH)), path, EPOCH)

    _drain(stream.writeStream.foreachBatch(partial), checkpoint or ledger(path))
    return spark.read.parquet(path).groupBy("date", *by).agg(*[F.sum(n).alias(n) for n in aggs])


def compact(spark: SparkSession, path: str, target: str, by: list[str], aggs: dict) -> int:
    """Fold the partial results of all epochs of :func:`daily_stream` into one epoch of a new table; returns the epochs read.

    The old table stays as it is until the caller has moved on: the stream then writes to ``target`` with
    ``checkpoint=ledger(path)``, and its next epochs add to the folded one. The stream must not run meanwhile.
    """
    table = spark.read.parquet(path)
    epochs = sorted(r[0] for r in table.select(EPOCH).distinct().collect())  # one number per epoch
    total = table.groupBy("date", *by).agg(*[F.sum(n).alias(n) for n in aggs])
    total.withColumn(EPOCH, F.lit(epochs[-1])).write.mode("overwrite").partitionBy(EPOCH).parquet(target)
    return len(epochs)


def closed_days(
    stream: DataFrame, path: str, by: list[str], aggs: dict, key: str, ts: str, delay: str,
    checkpoint: str | None = None,
) -> DataFrame:
    """Totals of days that the watermark has closed, each written once; keys repeated within the delay count once.

    A row later than the delay belongs to a day already published; ``land_stream`` keeps it.
    """
    spark = stream.sparkSession
    zone = spark.conf.get("spark.sql.session.timeZone")
    # windows are cut at midnight UTC, so the watermark runs on the local clock read as UTC
    totals = (
        stream.withColumn("_clock", F.from_utc_timestamp(ts, zone))
        .withWatermark("_clock", delay)
        .dropDuplicatesWithinWatermark([key])
        .groupBy(F.window("_clock", "1 day").alias("_w"), *by)
        .agg(*[a.alias(n) for n, a in aggs.items()])
        .select(F.expr("date_from_unix_date(cast(unix_seconds(_w.start) div 86400 as int))").alias("date"), *by, *aggs)
    )
    writer = totals.writeStream.outputMode("append").format("parquet").option("path", path)
    _drain(writer, checkpoint or ledger(path))
    return spark.read.parquet(path)


def _drain(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
