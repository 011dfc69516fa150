import datetime as dt

from pyspark.sql import functions as F

from conftest import pairs
from tidemark.session import scratch
from tidemark.streaming import ingest

T0 = dt.datetime(2024, 1, 1, 10)
SCHEMA = "id long, ts timestamp, ch string, v long"


def at(day, hour=10):
    return T0 + dt.timedelta(days=day, hours=hour - 10)


def drop(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return ingest.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)


FIRST = [(1, at(0), "a", 5), (2, at(0), "a", 7), (2, at(0), "a", 7), (3, at(1), "b", 1)]
LATE = [(1, at(0), "a", 5), (4, at(0), "b", 9), (5, at(9), "a", 2)]


def test_landing_keeps_late_rows_and_drops_repeats(spark):
    folder, table, mark = (scratch(spark, x) for x in ("in", "bronze", "mark"))
    drop(spark, folder, FIRST)
    assert ingest.land_stream(stream(spark, folder), table, "id", "ts", mark).count() == 3
    drop(spark, folder, LATE)
    out = ingest.land_stream(stream(spark, folder), table, "id", "ts", mark)
    assert pairs(out.select("id")) == [(1,), (2,), (3,), (4,), (5,)]
    assert pairs(out.where("id = 4").select(F.col("_day").cast("string"), "_epoch")) == [("2024-01-01", 1)]
    # nothing new: nothing happens
    assert ingest.land_stream(stream(spark, folder), table, "id", "ts", mark).count() == 5


def test_replayed_epoch_changes_nothing(spark):
    table = scratch(spark, "bronze")
    batch = spark.createDataFrame(FIRST, SCHEMA)
    for _ in range(2):
        fresh = ingest.fresh_rows(batch, 0, table, "id", "ts")
        ingest._replace(fresh, table, ingest.DAY, ingest.EPOCH)
    assert spark.read.parquet(table).count() == 3


def test_daily_totals_are_exact_whatever_comes_late(spark):
    folder, table, mark = (scratch(spark, x) for x in ("in", "daily", "mark"))
    aggs = {"n": F.count(F.lit(1)), "v": F.sum("v")}
    drop(spark, folder, FIRST)
    ingest.daily_stream(stream(spark, folder), table, ["ch"], aggs, "ts", mark)
    drop(spark, folder, LATE)
    out = ingest.daily_stream(stream(spark, folder), table, ["ch"], aggs, "ts", mark)
    batch = spark.read.schema(SCHEMA).parquet(folder).groupBy(F.to_date("ts").alias("date"), "ch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    assert pairs(out) == pairs(batch)


def test_a_backlog_in_many_epochs_equals_one(spark):
    folder, one, many = (scratch(spark, x) for x in ("in", "one", "many"))
    drop(spark, folder, FIRST)
    drop(spark, folder, LATE)
    schema = spark.createDataFrame([], SCHEMA).schema
    slow = ingest.file_stream(spark, folder, schema, maxFilesPerTrigger="1")
    a = ingest.land_stream(slow, many, "id", "ts")
    b = ingest.land_stream(stream(spark, folder), one, "id", "ts")
    assert a.select("_epoch").distinct().count() == 2
    assert pairs(a.select("id", "ts", "v")) == pairs(b.select("id", "ts", "v"))


def test_closed_days_are_written_once(spark):
    folder, table, mark = (scratch(spark, x) for x in ("in", "closed", "mark"))
    aggs = {"n": F.count(F.lit(1)), "v": F.sum("v")}

    def run():
        out = ingest.closed_days(stream(spark, folder), table, ["ch"], aggs, "id", "ts", "1 day", mark)
        return pairs(out.select(F.col("date").cast("string"), "ch", "n", "v"))

    drop(spark, folder, FIRST)
    assert run() == []
    drop(spark, folder, [(6, at(3), "a", 4)])
    days = [("2024-01-01", "a", 2, 12), ("2024-01-02", "b", 1, 1)]
    assert run() == days
    assert run() == days


def test_a_second_call_counts_nothing_twice(spark):
    folder, table, target = (scratch(spark, x) for x in ("in", "daily", "folded"))
    aggs = {"n": F.count(F.lit(1)), "v": F.sum("v")}
    drop(spark, folder, FIRST)
    once = pairs(ingest.daily_stream(stream(spark, folder), table, ["ch"], aggs, "ts"))
    assert pairs(ingest.daily_stream(stream(spark, folder), table, ["ch"], aggs, "ts")) == once
    drop(spark, folder, LATE)
    twice = pairs(ingest.daily_stream(stream(spark, folder), table, ["ch"], aggs, "ts"))
    assert ingest.compact(spark, table, target, ["ch"], aggs) == 2
    folded = spark.read.parquet(target)
    assert pairs(folded.select("date", "ch", "n", "v")) == twice
    drop(spark, folder, [(9, at(0), "a", 100)])
    last = ingest.daily_stream(stream(spark, folder), target, ["ch"], aggs, "ts", ingest.ledger(table))
    batch = spark.read.schema(SCHEMA).parquet(folder).groupBy(F.to_date("ts").alias("date"), "ch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    assert pairs(last) == pairs(batch)
