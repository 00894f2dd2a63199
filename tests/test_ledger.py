"""Request chunks: refused answers, re-landed chunks, resume after a crash."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from ashgrid.operators import weather as W
from ashgrid.plans import daily
from ashgrid.sinks import publish as P
from ashgrid.streaming import ledger as LG

DAY = "2024-07-15"


def document(chunk, n, temp=10.0, first=0):
    """The service's answer to a chunk, as one line."""
    return json.dumps([{"chunk": chunk, "latitude": 50.0 + i, "longitude": 1.0, "daily": {"time": [DAY], "temperature_2m_max": [temp + i + first]},
                        "hourly": {"time": [DAY + "T00:00:00"], "snow_depth": [0.5]}} for i in range(n)])


def land(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def requests(spark, chunks, size=3):
    rows = [(str(c), 10 * p, c * 100 + p, 50.0 + p, float(c)) for c in range(chunks) for p in range(size)]
    return spark.createDataFrame(rows, "chunk string, pos int, loc long, lat double, lon double")


def raw(spark, lines):
    return spark.createDataFrame([(x, f"f{i}") for i, x in enumerate(lines)], "value string, source_file string")


def test_answers_and_rejects(spark):
    req = requests(spark, 6).select("chunk", "pos", "loc")
    mixed = document(4, 3).replace('"chunk": 4', '"chunk": 5', 2).replace('"chunk": 5', '"chunk": 4', 1)
    lines = [document(0, 3), document(1, 2), document(2, 4), document(9, 3), "{broken", "", mixed, document(0, 3, 20.0), document(3, 3), document(3, 3)]
    answers, rejects = LG.zip_chunks(raw(spark, lines), req)
    got = sorted((r.chunk, r.loc, r.daily.temperature_2m_max[0]) for r in answers.collect())
    assert got == [("0", p, 20.0 + p) for p in range(3)] + [("3", 300 + p, 10.0 + p) for p in range(3)]
    assert sorted((r.chunk, r.reason) for r in rejects.collect()) == [
        ("1", "short"), ("2", "surplus"), ("4", "mixed chunks"), ("9", "not requested"), ("f4", "unreadable"), ("f5", "unreadable")]


def test_positional_zip_raises_when_computed(spark):
    req = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "chunk string, pos int")
    good = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, 3.0)], "chunk string, pos int, v double")
    assert W.positional_zip(req, good).count() == 3
    for bad in (good.filter("v <> 2.0"), good.union(spark.createDataFrame([("c", 0, 1.0)], good.schema)), good.filter("chunk = 'a'")):
        lazy = W.positional_zip(req, bad)
        with pytest.raises(Exception, match="response count differs"):
            lazy.collect()


def test_stream_keeps_chunk_states(spark):
    root = tempfile.mkdtemp(prefix="ashgrid-test-ledger-")
    landing, out, ck = f"{root}/landing", f"{root}/out", f"{root}/ck"
    req = requests(spark, 4).select("chunk", "pos", "loc")

    def compute(answers):
        return answers.select("chunk", "loc", F.col("daily.temperature_2m_max")[0].alias("t"))

    published = []

    def run():
        LG.stream_chunks(spark, f"{landing}/*", req, compute, out, ck, publish=lambda rows: published.append(rows.count()))

    def states():
        return {r.chunk: (r.status, r.documents, r.reason) for r in LG.stream_states(spark, out, req).collect()}

    land(spark, f"{landing}/a", [document(0, 3), document(1, 2)])
    run()
    assert states() == {"0": ("complete", 1, None), "1": ("refused", 1, "short"), "2": ("missing", 0, None), "3": ("missing", 0, None)}
    land(spark, f"{landing}/b", [document(1, 3), document(0, 2, 99.0), document(2, 4), document(7, 3)])
    run()
    # a refused answer does not replace an earlier good one
    assert states() == {"0": ("complete", 2, "short"), "1": ("complete", 2, "short"), "2": ("refused", 1, "surplus"),
                        "3": ("missing", 0, None), "7": ("not requested", 1, "not requested")}
    land(spark, f"{landing}/c", [document(0, 3, 50.0)])
    run()
    got = sorted((r.loc, r.t) for r in LG.stream_rows(spark, out).collect())
    assert got == [(0, 50.0), (1, 51.0), (2, 52.0), (100, 10.0), (101, 11.0), (102, 12.0)]
    assert published == [3, 6, 6]
    assert sorted(r.reason for r in spark.read.parquet(f"{out}/rejects").collect()) == ["not requested", "short", "short", "surplus"]


def test_a_replayed_batch_changes_nothing(spark):
    out = tempfile.mkdtemp(prefix="ashgrid-test-ledger-") + "/out"
    req = requests(spark, 2).select("chunk", "pos", "loc")
    batch = raw(spark, [document(0, 3), document(1, 1)])
    for _ in range(2):
        LG.stream_batch(batch, 5, req, lambda a: a.select("chunk", "loc"), out)
    assert LG.stream_rows(spark, out).count() == 3
    assert {(r.chunk, r.status, r.documents) for r in LG.stream_states(spark, out, req).collect()} == {("0", "complete", 1), ("1", "refused", 1)}


def test_daily_weather_resumes_by_chunk(spark):
    """Killed after some commits, the next run computes the other chunks only."""
    root = tempfile.mkdtemp(prefix="ashgrid-test-daily-")
    req, store = requests(spark, 12), f"{root}/weather"
    land(spark, f"{root}/landing", [document(c, 3, c) for c in range(11)] + [document(11, 2)])
    with pytest.raises(RuntimeError, match="no usable|without a usable"):
        daily.weather_for_grid(spark, f"{root}/landing", req, DAY, store, commits=6, stop_after=2)
    first = {r.chunk: r.commit for r in LG.finished(spark, store, DAY).collect()}
    assert 0 < len(first) < 11
    # rows of a commit that died before its log row are not read
    spark.read.parquet(f"{store}/rows").filter("false").drop("commit").write.parquet(f"{store}/rows/commit=c-dead")
    with pytest.raises(RuntimeError, match=r"11 \(short\)"):
        daily.weather_for_grid(spark, f"{root}/landing", req, DAY, store, commits=6)
    second = {r.chunk: r.commit for r in LG.finished(spark, store, DAY).collect()}
    assert len(second) == 11 and all(second[c] == first[c] for c in first)
    rows = spark.read.parquet(f"{store}/rows").groupBy("commit").count().collect()
    assert sum(r["count"] for r in rows) == 33  # no chunk was computed twice
    land(spark, f"{root}/landing2", [document(11, 3, 11)])
    out = daily.weather_for_grid(spark, f"{root}/landing2", req, DAY, store, commits=6)
    assert out.count() == 36 and out.select("loc").distinct().count() == 36
    assert LG.missing(spark, req, store, DAY).count() == 0
    # another day starts anew
    assert LG.finished(spark, store, "2024-07-16").count() == 0


def test_elevations_fill_the_serving_frame(spark):
    grid = spark.createDataFrame([(1, 50.0, 1.0), (2, 51.0, 1.0)], "gid long, lat double, lon double")
    weather = spark.createDataFrame([(1, 50.0, 1.0, 280.0)], "loc long, lat double, lon double, max_temp double").withColumn(
        "resolved_day", F.lit(DAY).cast("date"))
    heights = spark.createDataFrame([(50.00001, 1.0, 300.0)], "lat double, lon double, elevation double")
    none = spark.createDataFrame([(50.0, 1.0, 0.3)], "lat double, lon double, NDVI double")
    some = none.withColumn("elevation", F.lit(None).cast("double"))
    for static in (none, some):
        got = {r.gid: r.elevation for r in daily.assemble(grid, weather, static, DAY, elevations=heights).collect()}
        assert got == {1: 300.0, 2: 0.0}


def test_latest_switches_in_one_step(spark):
    path = tempfile.mkdtemp(prefix="ashgrid-test-latest-") + "/latest"
    with pytest.raises(FileNotFoundError):
        P.read_latest(spark, path)
    a = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "k int, date date")
    assert P.publish_latest(a, path) == 1
    # stopped between write and switch: the new folder is there, the manifest is not
    spark.createDataFrame([(2, dt.date(2024, 1, 2))], "k int, date date").write.parquet(f"{path}/versions/2-dead")
    assert [r.k for r in P.read_latest(spark, path).collect()] == [1]
    reader = P.read_latest(spark, path)
    assert P.publish_latest(a.withColumn("k", F.lit(3)), path) == 2
    assert [r.k for r in P.read_latest(spark, path).collect()] == [3]
    assert [r.k for r in reader.collect()] == [1]  # who reads the old version can finish
