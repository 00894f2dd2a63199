"""Checkpoints, publishing and resume lose and duplicate nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ashgrid import contract as C
from ashgrid.functions import scalar as S
from ashgrid.operators import cache as CA
from ashgrid.operators import filters as FL
from ashgrid.operators import raster as RA
from ashgrid.operators import splits as SP
from ashgrid.operators import timeseries as TS
from ashgrid.sinks import publish as P
from ashgrid.sources import files as SF
from ashgrid.streaming import incremental as INC


def test_chunks_under_one_key_add_up(spark, tmp_path):
    path = str(tmp_path / "ck")
    rows = spark.createDataFrame([(i, dt.date(2024, 1, 1), 0) for i in range(4)], "loc int, target_date date, step int")
    for chunk in (0, 1, 0):
        P.append_checkpoint(rows.filter(F.col("loc") % 2 == chunk), path, chunk)
    assert sorted(r["loc"] for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]


def test_resume_knows_the_target_date(spark, tmp_path):
    ckpt = str(tmp_path / "ck")
    grid = spark.range(10).select(F.col("id").alias("loc"))
    calls = []

    def compute(day, broken=False):
        def run(todo):
            ids = sorted(r["loc"] for r in todo.collect())
            if broken and calls:
                raise RuntimeError("lost")
            calls.append(ids)
            return todo.select("loc", F.lit(day).alias("v"))
        return run

    INC.resume_batch(spark, grid, compute("a"), ckpt, ["loc"], "2024-01-01", run_seq=1, chunks=3)
    assert sorted(sum(calls, [])) == list(range(10))
    calls.clear()
    with pytest.raises(RuntimeError):  # the second day breaks off after its first part
        INC.resume_batch(spark, grid, compute("b", broken=True), ckpt, ["loc"], "2024-01-02", run_seq=2, chunks=3)
    out = INC.resume_batch(spark, grid, compute("b"), ckpt, ["loc"], "2024-01-02", run_seq=3, chunks=3)
    assert sorted(sum(calls, [])) == list(range(10))  # nothing twice
    assert {r["v"] for r in out.collect()} == {"b"} and out.count() == 10


def test_latest_has_one_row_per_key(spark, tmp_path):
    root = str(tmp_path)

    def process(batch):
        x = F.split("value", ",")
        return batch.select(x[0].cast("int").alias("loc"), x[1].cast("date").alias("resolved_day"), x[2].alias("v"))

    for n, lines in enumerate((["1,2024-01-01,a", "2,2024-01-01,a"], ["2,2024-01-01,b", "3,2024-01-01,b"])):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/landing/d{n}")
        INC.resume_stream(spark, f"{root}/landing/*", process, f"{root}/out", f"{root}/ck", latest=f"{root}/latest")
    assert sorted((r["loc"], r["v"]) for r in P.read_latest(spark, f"{root}/latest").collect()) == [(1, "a"), (2, "b"), (3, "b")]


def test_rerun_of_an_older_day_is_its_own_latest(spark, tmp_path):
    dated, latest = str(tmp_path / "dated"), str(tmp_path / "latest")
    for day in ("2024-01-02", "2024-01-01"):
        P.write_dated_and_latest(spark.createDataFrame([(day,)], "x string").withColumn("date", F.lit(day).cast("date")), dated, latest)
    assert [r["x"] for r in P.read_latest(spark, latest).collect()] == ["2024-01-01"]
    assert spark.read.parquet(dated).count() == 2
    P.write_dated_and_latest(spark.createDataFrame([("c",)], "x string").withColumn("date", F.lit("2023-01-01").cast("date")), dated, latest,
                             newest_overall=True)
    assert [r["x"] for r in P.read_latest(spark, latest).collect()] == ["2024-01-02"]


def test_null_groups_and_keys_stay(spark):
    rows = [(i, None if i % 80 == 0 else i % 80, dt.date(2024, 1, 1 + i // 160)) for i in range(320)]
    df = spark.createDataFrame(rows, "id int, g int, d date")
    assert FL.latest_or_pinned(df, "d", per=["g"]).count() == 160
    blocked = TS.add_rolling(df, "g", ["d", "id"], {"s": ("id", 3, "sum")}, block_rows=2)
    plain = TS.add_rolling(df, "g", ["d", "id"], {"s": ("id", 3, "sum")})
    assert sorted(map(str, blocked.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_an_all_null_newest_slice_has_no_pixels(spark):
    rows = [("a", dt.date(2024, 1, 1), 1.0, 1.0, 5.0), ("a", dt.date(2024, 1, 2), 1.0, 1.0, None)]
    assert CA.pixels_latest(spark.createDataFrame(rows, "layer string, date date, lat double, lon double, value double")).count() == 0


def test_a_key_that_begins_later_gets_zeros(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.0), ("b", dt.date(2024, 2, 1), 3.0)], "k string, d date, x double")
    out = TS.trailing(df, "k", "d", {"s": ("x", 7, "sum"), "m": ("x", 7, "mean")}, upto=F.lit("2024-01-10").cast("date"))
    assert sorted(map(tuple, out.select("k", "s", "m").collect())) == [("a", 2.0, 2.0), ("b", 0.0, 0.0)]


def test_names_columns_and_rounding(spark, tmp_path):
    p = RA.parse_layer_and_date("path")
    r = spark.createDataFrame([("x/lake_doyle_EVI_doy2023010.tif",)], "path string").select(p["layer"], p["date"]).first()
    assert tuple(r) == ("EVI", "2023-01-10")
    both = spark.createDataFrame([(1, 2)], "date int, DATE_TIME int")
    assert C.resolve_column(both, C.ALIASES["date"]) == "DATE_TIME"
    spark.createDataFrame([("7", "-120", "50")], "id string, lon string, lat string").write.option("header", True).csv(str(tmp_path / "g"))
    assert tuple(SF.grid_file(spark, str(tmp_path / "g")).first()) == (50.0, -120.0)
    xs = spark.createDataFrame([(x,) for x in (0.25, 0.35, 1.15, 2.25, 12345.67, -0.25)], "x double").select(S.round1("x")).collect()
    assert [r[0] for r in xs] == [0.2, 0.3, 1.1, 2.2, 12345.7, -0.2]


def test_undated_rows_are_on_neither_side(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 3, 1),), (None,)], "d date")
    assert [r["split"] for r in SP.temporal_split_tag(df, "d", "2024-02-01").collect()] == ["train", "test", None]
