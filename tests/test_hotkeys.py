"""Block-parallel windows equal the one-task-per-key windows, with one key
holding a third of the rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ashgrid.operators import hotkeys as HK
from ashgrid.operators import timeseries as TS


def _skewed(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):  # the hot key: a third of all rows
        rows.append(("hot", dt.date(2000, 1, 1) + dt.timedelta(days=i), i, None if rnd.random() < 0.5 else float(rnd.randint(0, 99))))
    for k in range(40):
        for i in range(30):
            rows.append((f"k{k}", dt.date(2000, 1, 1) + dt.timedelta(days=i), i, None if rnd.random() < 0.3 else float(i)))
    # a long all-null run inside the hot key that spans several blocks
    rows = [(k, d, i, None if (k == "hot" and 100 <= i < 260) else v) for k, d, i, v in rows]
    return spark.createDataFrame(rows, "st string, d date, id int, v double")


def _same(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


def test_global_positions(spark):
    df = _skewed(spark)
    got = {(r.st, r.id): r["__pos"] for r in HK.global_positions(df, "st", ["d", "id"], parts=7).collect()}
    assert all(got[("hot", i)] == i + 1 for i in range(600))
    assert all(got[("k3", i)] == i + 1 for i in range(30))


def test_rolling_blocked_equals_plain(spark):
    df = _skewed(spark)
    specs = {"s7": ("v", 7, "sum"), "m30": ("v", 30, "mean")}
    plain = {(r.st, r.id): r for r in TS.add_rolling(df, "st", ["d", "id"], specs).collect()}
    blocked = HK.rolling_blocked(df, "st", ["d", "id"], specs, block_rows=64, parts=5).collect()
    assert len(blocked) == len(plain)
    for r in blocked:
        p = plain[(r.st, r.id)]
        assert _same(r.s7, p.s7) and _same(r.m30, p.m30)


def test_interpolate_blocked_equals_plain(spark):
    df = _skewed(spark)
    plain = {(r.st, r.id): r.v for r in TS.interpolate(df, "st", ["d", "id"], ["v"]).collect()}
    blocked = HK.interpolate_blocked(df, "st", ["d", "id"], ["v"], block_rows=50, parts=6).collect()
    assert len(blocked) == len(plain)
    assert all(_same(r.v, plain[(r.st, r.id)]) for r in blocked)


def test_interpolate_blocked_two_columns_without_edges(spark):
    df = _skewed(spark).withColumn("w", F.when(F.col("id") % 7 == 0, F.col("id").cast("double")))
    plain = {(r.st, r.id): (r.v, r.w) for r in TS.interpolate(df, "st", ["d", "id"], ["v", "w"], fill_edges=False).collect()}
    blocked = HK.interpolate_blocked(df, "st", ["d", "id"], ["v", "w"], fill_edges=False, block_rows=40, parts=4).collect()
    assert all(_same(r.v, plain[(r.st, r.id)][0]) and _same(r.w, plain[(r.st, r.id)][1]) for r in blocked)


def test_only_hot_keys_run_in_blocks(spark):
    df = _skewed(spark)
    others, hot = HK.split_hot(df, "st", 64)
    assert hot.select("st").distinct().collect()[0].st == "hot" and hot.count() == 600 and others.count() == 1200
    assert HK.split_hot(df, "st", 600)[1] is None
    plan = HK.rolling_blocked(df, "st", ["d", "id"], {"s7": ("v", 7, "sum")}, block_rows=600)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window") == 1 and "Join" not in plan


def test_null_key_may_be_hot(spark):
    df = _skewed(spark).withColumn("st", F.when(F.col("st") != "hot", F.col("st")))  # the hot key is null now
    specs = {"s7": ("v", 7, "sum")}
    plain = sorted((r.st or "", r.id, r.s7 if r.s7 is not None else -1) for r in TS.add_rolling(df, "st", ["d", "id"], specs).collect())
    blocked = HK.rolling_blocked(df, "st", ["d", "id"], specs, block_rows=50, parts=5)
    assert sorted((r.st or "", r.id, r.s7 if r.s7 is not None else -1) for r in blocked.collect()) == plain
    filled = {(r.st, r.id): r.v for r in HK.interpolate_blocked(df, "st", ["d", "id"], ["v"], block_rows=50, parts=5).collect()}
    assert filled == {(r.st, r.id): r.v for r in TS.interpolate(df, "st", ["d", "id"], ["v"]).collect()}


def test_empty_table(spark):
    df = _skewed(spark).filter("id < 0")
    assert HK.rolling_blocked(df, "st", ["d", "id"], {"s7": ("v", 7, "sum")}, block_rows=50).count() == 0
    assert HK.interpolate_blocked(df, "st", ["d", "id"], ["v"], block_rows=50).count() == 0
