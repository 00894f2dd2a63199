"""Request chunks: which ones are answered, which answers are refused, and what
a run that stopped has already finished (JOIN-5, INC-1..3).

A request chunk asks for the features of a bounded number of locations and is
answered by one document, an array with one object per location in the order of
the request.  A document can only be aligned if it has as many objects as the
chunk has locations, so every document is judged as a whole: good, or refused
with a reason.  Refused documents go to a table of rejects; they never reach the
results, and never replace an earlier good answer of their chunk.

State is kept in tables that only ever gain partitions.  A batch or commit first
writes its rows under a name of its own and then, as its last step, one log row
per finished chunk; readers join the rows with the log.  A run that dies between
the two leaves rows that nobody reads, and the next run does these chunks again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.weather import PAYLOAD_SCHEMA

LOG_SCHEMA = "chunk string, commit string, target_date date"
REJECT_COLUMNS = ["chunk", "source_file", "doc", "requested", "returned", "reason"]


def documents(raw: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA) -> DataFrame:
    """Text rows (value, source_file) -> one row per document: chunk, source_file,
    doc (hash of the text), objects (null if it cannot be read) and returned."""
    v = F.col("value")
    objects = F.when(F.ltrim(v).startswith("["), F.from_json(v, T.ArrayType(schema))).otherwise(
        F.when(F.ltrim(v).startswith("{"), F.array(F.from_json(v, schema))))
    rows = raw.select("source_file", F.xxhash64(v).alias("doc"), objects.alias("objects"))
    return rows.select(F.coalesce(F.get("objects", F.lit(0))["chunk"].cast("string"), F.col("source_file")).alias("chunk"),
                       "source_file", "doc", "objects", F.coalesce(F.size("objects"), F.lit(0)).alias("returned"))


def judge(docs: DataFrame, requests: DataFrame) -> DataFrame:
    """``documents`` with ``requested`` and ``reason`` (null: good).  ``requests``
    has chunk, pos and the location's columns."""
    asked = requests.groupBy("chunk").agg(F.count(F.lit(1)).cast("int").alias("requested"))
    mixed = F.exists("objects", lambda o: o["chunk"].cast("string") != F.col("chunk"))
    lost = F.exists("objects", lambda o: o["daily"].isNull() & o["hourly"].isNull())  # what cannot be parsed has no fields
    return docs.join(asked, "chunk", "left").withColumn(
        "reason", F.when(F.col("objects").isNull() | lost, "unreadable").when(F.col("requested").isNull(), "not requested")
        .when(F.col("returned") < F.col("requested"), "short").when(F.col("returned") > F.col("requested"), "surplus")
        .when(mixed, "mixed chunks"))


def zip_chunks(raw: DataFrame, requests: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(answers, rejects), both lazy: the i-th requested location with the i-th
    object of its chunk's document.  Of several good documents of a chunk the
    one that comes last by file name (then hash) counts."""
    judged = judge(documents(raw, schema), requests)
    good = judged.filter(F.col("reason").isNull())
    last = good.groupBy("chunk").agg(F.max(F.struct("source_file", "doc")).alias("w")).select("chunk", "w.source_file", "w.doc")
    rows = good.join(last, ["chunk", "source_file", "doc"], "left_semi").dropDuplicates(["chunk"])
    fields = [F.col(f"o.{f.name}").alias(f.name) for f in schema if f.name != "chunk"]
    # positions follow the order of the request, whatever numbers it uses for them
    asked = requests.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("pos", *[c for c in requests.columns if c not in ("chunk", "pos")]))).alias("asked"))
    pairs = rows.join(asked, "chunk").select("chunk", F.inline(F.arrays_zip(F.col("asked").alias("r"), F.col("objects").alias("o"))))
    answers = pairs.select("chunk", "r.*", *fields)
    return answers, judged.filter(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def finished(spark: SparkSession, store: str, target_date: str) -> DataFrame | None:
    """(chunk, commit) of the target date's finished chunks; the log is append-only."""
    log = _read(spark, f"{store}/log", LOG_SCHEMA)
    if log is None:
        return None
    log = log.filter(F.col("target_date") == F.lit(target_date).cast("date"))
    return log.groupBy("chunk").agg(F.max("commit").alias("commit"))


def results(spark: SparkSession, store: str, target_date: str) -> DataFrame | None:
    """Rows of the finished chunks, each chunk from the commit that the log names."""
    done = finished(spark, store, target_date)
    rows = _read(spark, f"{store}/rows")
    if done is None or rows is None:
        return None
    return rows.join(done, ["chunk", "commit"], "left_semi").drop("commit")


def run_chunks(spark: SparkSession, raw: DataFrame, requests: DataFrame, compute: Callable[[DataFrame], DataFrame], store: str,
               target_date: str, commits: int = 1, stop_after: int | None = None) -> DataFrame | None:
    """Compute what the target date has not finished, in ``commits`` parts.

    ``compute`` turns answers into rows that keep ``chunk``.  Every part is
    written, then logged chunk by chunk; a chunk without a good document is not
    logged and is tried again by the next run.  Returns the finished rows.
    ``stop_after`` ends the run after so many commits."""
    done = finished(spark, store, target_date)
    todo = requests if done is None else requests.join(done, "chunk", "left_anti")
    part = F.pmod(F.xxhash64("chunk"), F.lit(commits))
    day = F.lit(target_date).cast("date")
    made = 0
    for i in range(commits):
        asked = todo.filter(part == i)
        if asked.isEmpty():
            continue
        if stop_after is not None and made >= stop_after:
            break
        commit = f"c-{uuid.uuid4().hex}"
        answers, rejects = zip_chunks(raw, asked)
        rows = compute(answers)
        rows.write.parquet(f"{store}/rows/commit={commit}")
        (rejects.filter("reason <> 'not requested'").withColumns({"commit": F.lit(commit), "target_date": day})
         .write.mode("append").parquet(f"{store}/rejects"))
        kept = spark.read.schema(rows.schema).parquet(f"{store}/rows/commit={commit}")
        (kept.select("chunk").distinct().select(F.col("chunk").cast("string").alias("chunk"), F.lit(commit).alias("commit"), day.alias("target_date"))
         .coalesce(1).write.mode("append").parquet(f"{store}/log"))
        made += 1
    return results(spark, store, target_date)


def missing(spark: SparkSession, requests: DataFrame, store: str, target_date: str) -> DataFrame:
    """Requested chunks that are not finished, with the reason of their last
    refused document (null: no document came)."""
    done = finished(spark, store, target_date)
    open_ = requests.select("chunk").distinct()
    if done is not None:
        open_ = open_.join(done, "chunk", "left_anti")
    rejects = _read(spark, f"{store}/rejects")
    if rejects is None:
        return open_.withColumn("reason", F.lit(None).cast("string"))
    why = (rejects.filter(F.col("target_date") == F.lit(target_date).cast("date"))
           .groupBy("chunk").agg(F.max_by("reason", F.struct("source_file", "doc")).alias("reason")))
    return open_.join(why, "chunk", "left")


def stream_batch(batch: DataFrame, batch_id: int, requests: DataFrame, compute: Callable[[DataFrame], DataFrame], out: str) -> None:
    """One micro-batch: rows, rejects and, last, the chunk states, each in the
    batch's own partition, so that a replay replaces exactly what it wrote."""
    batch.persist()
    try:
        answers, rejects = zip_chunks(batch, requests)
        rows = compute(answers).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        judged = judge(documents(batch), requests)
        states = judged.groupBy("chunk").agg(
            F.max("requested").alias("requested"), F.count(F.lit(1)).alias("documents"),
            F.count_if(F.col("reason").isNull()).alias("good"), F.max_by("reason", F.struct("source_file", "doc")).alias("reason"))
        for name, df in (("rows", rows), ("rejects", rejects), ("states", states)):
            (df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out}/{name}"))
    finally:
        batch.unpersist()


def stream_chunks(spark: SparkSession, landing: str, requests: DataFrame, compute: Callable[[DataFrame], DataFrame], out: str,
                  checkpoint: str, publish: Callable[[DataFrame], None] | None = None) -> None:
    """Every landed text file once (availableNow), then stop.  ``publish`` gets the
    rows of all good chunks after each micro-batch."""
    def each(batch: DataFrame, batch_id: int) -> None:
        stream_batch(batch, batch_id, requests, compute, out)
        if publish is not None:
            publish(stream_rows(spark, out))

    stream = (spark.readStream.format("text").option("maxFilesPerTrigger", 1000).load(landing)
              .select("value", F.col("_metadata.file_path").alias("source_file")))
    query = (stream.writeStream.foreachBatch(each)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def stream_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows of each chunk's last good batch: a re-landed chunk replaces its
    rows as a whole, a refused one changes nothing."""
    rows, states = spark.read.parquet(f"{out}/rows"), spark.read.parquet(f"{out}/states")
    last = states.filter("good > 0").groupBy("chunk").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, ["chunk", "batch_id"], "left_semi").drop("batch_id")


def stream_states(spark: SparkSession, out: str, requests: DataFrame) -> DataFrame:
    """Completeness over all micro-batches, one row per requested or delivered
    chunk: status complete, refused, missing or not requested; documents seen; the
    reason of the last refusal."""
    states = spark.read.parquet(f"{out}/states").groupBy("chunk").agg(
        F.sum("documents").alias("documents"), F.sum("good").alias("good"), F.max_by("reason", F.when(F.col("reason").isNotNull(), F.col("batch_id"))).alias("reason"))
    asked = requests.select("chunk").distinct().withColumn("asked", F.lit(True))
    status = (F.when(F.col("asked").isNull(), "not requested").when(F.col("good") > 0, "complete")
              .when(F.col("documents") > 0, "refused").otherwise("missing"))
    return asked.join(states, "chunk", "full").select(
        "chunk", status.alias("status"), F.coalesce("documents", F.lit(0)).cast("long").alias("documents"), "reason")
