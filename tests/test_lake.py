from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from conftest import pairs
from tidemark.operators import quality
from tidemark.sources import bronze
from tidemark.sources import lake as lk


def test_batch_replace(spark, lake):
    df = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    assert lake.row_count("bronze.t") == 0
    assert lake.write("bronze.t", df, "overwrite", "b1") == 3
    assert lake.row_count("bronze.t") == 3
    assert lake.write("bronze.t", df, "append", "b1") == 3
    assert lake.row_count("bronze.t") == 3
    lake.write("bronze.t", df, "append", "b2")
    assert lake.row_count("bronze.t") == 6
    lake.write("bronze.t", df.limit(1), "overwrite", "b9")
    assert lake.row_count("bronze.t") == 1


def test_bad_calls(spark, lake):
    df = spark.range(1)
    with pytest.raises(ValueError):
        lake.write("bronze.t", df, "upsert", "b")
    with pytest.raises(ValueError):
        lake.write("t", df, "append", "b")
    with pytest.raises(NotImplementedError):
        lk.read_source(spark, "rest", "/nowhere")


def test_batches_of_different_shape(spark, lake):
    lake.write("bronze.t", spark.createDataFrame([(1, "x")], "a int, b string"), "append", "007")
    lake.write("bronze.t", spark.createDataFrame([(2,)], "a int"), "append", "c:2024-01-01")
    rows = lake.scan("bronze.t", keep_batch=True).select("a", "b", "_batch")
    assert pairs(rows.where("b is not null")) == [(1, "x", "007")]
    assert pairs(rows.where("b is null").select("a", "_batch")) == [(2, "c:2024-01-01")]


def test_many_batches_in_one_job(spark, lake):
    df = spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("d"))
    for _ in range(2):
        assert lake.write("bronze.t", df, "append", F.col("d")) == 100
    lake.write("bronze.t", df.where("d = '1'").limit(5), "append", F.col("d"))
    assert lake.row_count("bronze.t") == 80
    pruned = lake.scan("bronze.t", keep_batch=True).where("_batch = '2'")
    assert pruned.count() == 25
    assert "PartitionFilters: [isnotnull(_batch" in pruned._jdf.queryExecution().toString()


def test_merge_batch(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, _batch string")
    new = spark.createDataFrame([(9, "z")], "x int, y string")
    assert pairs(lk.merge_batch(old, new, "a").select("x", "y").na.fill("")) == [(2, ""), (3, ""), (9, "z")]


def test_incremental_window_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    day = bronze.incremental_window(events, "ts", "2024-01-15")
    assert day.count() == events.where("to_date(ts) = '2024-01-15'").count() > 0
    assert "GreaterThanOrEqual(ts" in day._jdf.queryExecution().toString()


def test_sql_over_tables(spark, lake):
    lake.write("silver.dim_x", spark.range(3), "overwrite", "b")
    assert lake.sql("SELECT sum(id) FROM silver_dim_x", ["silver.dim_x"]).first()[0] == 3


def test_no_rows_replace_a_batch(spark, lake):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    lake.write("bronze.t", df, "append", "s:2024-01-01")
    lake.write("bronze.t", df, "append", "s:2024-01-02")
    assert lake.write("bronze.t", df.limit(0), "append", "s:2024-01-01") == 0
    assert pairs(lake.scan("bronze.t", keep_batch=True).select("_batch").distinct()) == [("s:2024-01-02",)]
    assert lake.write("bronze.t", df.limit(0), "overwrite", "s:x") == 0
    assert lake.scan("bronze.t").columns == ["a"] and lake.row_count("bronze.t") == 0


@pytest.mark.parametrize("batch", ["a:b", "50%", "x=y/z", "q?[*]", "plain 1"])
def test_batch_names_survive(spark, lake, batch):
    lake.write("bronze.t", spark.range(1), "append", F.lit(batch))
    lake.write("bronze.t", spark.range(2), "append", batch)
    assert pairs(lake.scan("bronze.t", keep_batch=True).select("_batch")) == [(batch,), (batch,)]


def test_a_day_without_rows_is_cleared(spark, lake):
    rows = [("2024-01-01 10:00:00", 1), ("2024-01-02 10:00:00", 2), ("2024-01-03 10:00:00", 3)]
    df = spark.createDataFrame(rows, "ts string, v int").withColumn("ts", F.col("ts").cast("timestamp"))

    def land(data):
        cfg = bronze.SourceConfig("s", "s", lambda: data, "incremental", "ts", "bronze.t")
        return bronze.land(lake, [cfg], {}, "r", "2024-01-01", "2024-01-03").rows

    assert land(df) == {"bronze.t": 3}
    assert land(df.where("v != 2")) == {"bronze.t": 2}
    assert pairs(lake.scan("bronze.t").select("v")) == [(1,), (3,)]
    assert set(bronze.LINEAGE) <= set(lake.scan("bronze.t").columns)


def test_window_without_rows_lands_empty_days(spark, lake):
    df = spark.createDataFrame([], "ts timestamp, v int")
    cfg = bronze.SourceConfig("s", "s", lambda: df, "incremental", "ts", "bronze.s", contract="s")
    landed = bronze.land(lake, [cfg], {}, "r", "2024-01-01", "2024-01-03", {"s": {"not_null": ["v"]}})
    assert landed.rows == {"bronze.s": 0} and landed.broken == {"s": {"not_null[v]": 0}}
    assert lake.scan("bronze.s").count() == 0 and "v" in lake.scan("bronze.s").columns


def test_landing_counts_broken_rows_as_it_writes(spark, lake):
    rows = [("2024-01-01 10:00:00", 1, "a"), ("2024-01-03 10:00:00", None, "b"), ("2024-01-03 11:00:00", 900, "z"), ("2024-01-09 11:00:00", None, "z")]
    df = spark.createDataFrame(rows, "ts string, v int, k string").withColumn("ts", F.to_timestamp("ts"))
    contract = {"not_null": ["v"], "ranges": {"v": {"min": 0, "max": 100}}, "allowed_values": {"k": ["a", "b"]}}
    cfg = bronze.SourceConfig("s", "s", lambda: df, "incremental", "ts", "bronze.s", contract="s")
    landed = bronze.land(lake, [cfg], {}, "r", "2024-01-01", "2024-01-04", {"s": contract})
    assert landed.rows == {"bronze.s": 3}
    assert landed.broken == {"s": {"not_null[v]": 1, "allowed_values[k]": 1, "range[v]": 1}}
    checks = lambda **kw: sorted(map(tuple, quality.validate(lake.scan("bronze.s"), contract, **kw).collect()))
    assert checks(broken=landed.broken["s"]) == checks()
    files = map(unquote, map(unquote, lake.scan("bronze.s", keep_batch=True).inputFiles()))
    assert {p.split("_batch=")[1].split("/")[0] for p in files} == {f"s:2024-01-0{d}" for d in (1, 2, 3, 4)}


def test_late_rows_land_once_in_their_day(spark, lake):
    state = [("2024-01-01 10:00:00", 1), ("2024-01-02 10:00:00", 2), ("2024-01-05 10:00:00", 3)]
    read = lambda: spark.createDataFrame(state, "ts string, v int").withColumn("ts", F.to_timestamp("ts"))
    cfg = bronze.SourceConfig("s", "s", read, "incremental", "ts", "bronze.s")
    assert bronze.land_since(lake, cfg, "r1", "2024-01-05") == ["2024-01-01", "2024-01-02", "2024-01-05"]
    assert bronze.land_since(lake, cfg, "r2", "2024-01-06") == []
    state += [("2024-01-02 23:00:00", 4), ("2024-01-06 00:00:00", 5), ("2024-01-07 00:00:00", 6)]
    state[2] = ("2024-01-05 10:00:00", 30)  # corrected
    assert bronze.land_since(lake, cfg, "r3", "2024-01-06") == ["2024-01-02", "2024-01-05", "2024-01-06"]
    got = lake.scan("bronze.s").select("v", "_run_id")
    assert pairs(got) == [(1, "r1"), (2, "r3"), (4, "r3"), (5, "r3"), (30, "r3")]
    del state[3]  # taken back, beyond the lookback nothing is read
    assert bronze.land_since(lake, cfg, "r4", "2024-01-06", lookback=1) == []
    assert bronze.land_since(lake, cfg, "r4", "2024-01-06") == ["2024-01-02"]
    state.append(("2024-01-05 11:00:00", 7))
    del state[0]
    assert bronze.land_since(lake, cfg, "r5", "2024-01-06") == ["2024-01-01", "2024-01-05"]
    assert pairs(lake.scan("bronze.s").select("v")) == [(2,), (5,), (7,), (30,)]
