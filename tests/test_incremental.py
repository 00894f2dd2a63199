"""Resumable runs: the stream processes each landed file once; batch resume
computes only missing keys."""

import tempfile

from pyspark.sql import functions as F

from ashgrid.streaming import incremental as INC


def _land(spark, path, start, n):
    docs = [(f'[{{"latitude": {float(i)}, "longitude": 0.0}}]',) for i in range(start, start + n)]
    spark.createDataFrame(docs, "value string").coalesce(1).write.mode("overwrite").text(path)


def _process(batch):
    return batch.select(F.get_json_object("value", "$[0].latitude").cast("double").alias("lat"),
                        F.lit(None).cast("date").alias("resolved_day"))


def test_stream_processes_new_files_only(spark):
    root = tempfile.mkdtemp(prefix="ashgrid-test-stream-")
    landing, out, ck = f"{root}/landing", f"{root}/out", f"{root}/ck"
    _land(spark, f"{landing}/a", 0, 5)
    INC.resume_stream(spark, f"{landing}/*", _process, out, ck)
    first = spark.read.parquet(out)
    assert first.count() == 5 and first.select("batch_id").distinct().count() == 1
    INC.resume_stream(spark, f"{landing}/*", _process, out, ck)  # nothing new: no batch
    assert spark.read.parquet(out).count() == 5
    _land(spark, f"{landing}/b", 3, 4)  # overlaps keys 3, 4
    INC.resume_stream(spark, f"{landing}/*", _process, out, ck)
    allr = spark.read.parquet(out)
    assert allr.select("batch_id").distinct().count() == 2
    assert {r.lat for r in INC.stream_results(spark, out, ["lat"]).collect()} == {float(i) for i in range(7)}


def test_batch_resume_computes_only_missing(spark):
    ckpt = tempfile.mkdtemp(prefix="ashgrid-test-resume-") + "/ck"
    grid = spark.range(10).select(F.col("id").alias("loc"))
    seen = []

    def compute(todo):
        seen.append(sorted(r.loc for r in todo.collect()))
        return todo.withColumn("v", F.col("loc") * 2)

    INC.resume_batch(spark, grid.filter("loc < 4"), compute, ckpt, ["loc"], "2024-01-01", run_seq=1)
    out = INC.resume_batch(spark, grid, compute, ckpt, ["loc"], "2024-01-01", run_seq=2)
    assert seen == [[0, 1, 2, 3], [4, 5, 6, 7, 8, 9]]
    assert sorted((r.loc, r.v) for r in out.collect()) == [(i, 2 * i) for i in range(10)]
    # a third run finds nothing to do
    INC.resume_batch(spark, grid, compute, ckpt, ["loc"], "2024-01-01", run_seq=3)
    assert len(seen) == 2
