import datetime as dt
import random

from conftest import pairs
from tidemark.operators import history, slices

D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def log(seed=3, keys=6, days=20, rows=300):
    """States of a few keys; key 0 has a third of the rows."""
    rnd = random.Random(seed)
    return [(0 if rnd.random() < 0.33 else rnd.randrange(keys), day(rnd.randrange(days)), i, rnd.choice("xyz"))
            for i in range(rows)]


def brute_versions(rows):
    last = {}
    for k, d, seq, attr in sorted(rows, key=lambda r: r[2]):
        last[(k, d)] = attr
    out = []
    for k in sorted({k for k, _ in last}):
        prev = None
        for d in sorted(d for kk, d in last if kk == k):
            if last[(k, d)] != prev:
                if prev is not None:
                    out[-1][3] = d
                out.append([k, last[(k, d)], d, None])
                prev = last[(k, d)]
    return [tuple(v) for v in out]


def test_history_and_asof(spark):
    rows = log()
    df = spark.createDataFrame(rows, "k int, d date, seq int, attr string")
    versions = history.scd2_history(df, "k", "d", ["attr"], "seq")
    expected = brute_versions(rows)
    got = [(r.k, r.attr, r.valid_from, r.valid_to) for r in versions.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert all(r.is_current == (r.valid_to is None) for r in versions.collect())

    rnd = random.Random(9)
    facts = [(i, rnd.randrange(8), day(rnd.randrange(-2, 24))) for i in range(400)]
    joined = history.scd2_asof(spark.createDataFrame(facts, "id int, k int, day date"), versions, "k", "day", ["attr"])
    want = {}
    for i, k, d in facts:
        hit = [v for v in expected if v[0] == k and v[2] <= d and (v[3] is None or d < v[3])]
        want[i] = (hit[0][1], hit[0][2]) if hit else (None, None)
    assert {r.id: (r.attr, r.valid_from) for r in joined.collect()} == want


def test_apply_day_by_day_equals_history(spark):
    rows = log(5, 4, 6, 60)
    schema = "k int, d date, seq int, attr string"
    dim = spark.createDataFrame([], "k int, attr string, valid_from date, valid_to date, is_current boolean")
    for n in range(6):
        seen = [r for r in rows if r[1] == day(n)]
        snap = history.dedup_latest(spark.createDataFrame(seen, schema), ["k"], ["seq"]).select("k", "attr")
        dim = spark.createDataFrame(history.scd2_apply(dim, snap, "k", ["attr"], str(day(n))).collect(), dim.schema)
    whole = history.scd2_history(spark.createDataFrame(rows, schema), "k", "d", ["attr"], "seq")
    key = "k", "attr", "valid_from", "valid_to", "is_current"
    assert sorted(dim.select(*key).collect(), key=str) == sorted(whole.select(*key).collect(), key=str)


def test_dedup_latest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, None, "c"), (2, None, "d")], "k int, ts int, v string")
    assert pairs(history.dedup_latest(df, ["k"], ["ts"]).select("k", "v")) == [(1, "b"), (2, "d")]


def test_dense_key_is_ordered_and_stable(spark):
    ids = list(range(0, 5000, 7))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id int").repartition(5)
    want = [(n, i) for n, i in enumerate(sorted(ids), start=1)]
    for n in (1, 4, 13):
        assert pairs(slices.dense_key(df, ["id"], "sk", n)) == want


def test_stable_key_keeps_old_keys(spark):
    stored = slices.dense_key(spark.createDataFrame([("b",), ("d",)], "id string"), ["id"], "sk", 2)
    snap = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    assert pairs(slices.stable_key(snap, stored, "id", "sk", 2).select("id", "sk")) == [
        ("a", 3), ("b", 1), ("c", 4), ("d", 2)]


def test_running_sum_with_a_key_over_many_slices(spark):
    rnd = random.Random(4)
    rows = [(7 if rnd.random() < 0.4 else rnd.randrange(40), rnd.randrange(50), i, rnd.randrange(-9, 10)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, ts int, id int, v int")
    totals, want = {}, {}
    for k, _, i, v in sorted(rows):
        totals[k] = totals.get(k, 0) + v
        want[i] = totals[k]
    out = slices.running_sum(df, "k", ["ts", "id"], "v", "total", 9)
    assert {r.id: int(r.total) for r in out.collect()} == want
    stored = slices.ordered_slices(df, ["k", "ts", "id"], 9)
    per_slice = [r["count"] for r in stored.groupBy("_slice").count().collect()]
    assert len(per_slice) == 9 and max(per_slice) < 0.25 * len(rows)  # the hot key is no slice of its own
