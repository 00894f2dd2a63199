"""Landed weather payloads (SRC-4).

A payload file holds one JSON object or a JSON array of objects, each with
``latitude``, ``longitude`` and parallel arrays under ``daily`` and
``hourly``.  ``spark.read.json(multiLine=True)`` reads both shapes (an array
becomes one row per element); ``inline(arrays_zip(...))`` turns the parallel
arrays into long rows, inside the task that read the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as C

_ARR = T.ArrayType(T.DoubleType())

DAILY_SCHEMA = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))] + [T.StructField(v, _ARR) for v in C.DAILY_VARS]
)
HOURLY_SCHEMA = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))] + [T.StructField(v, _ARR) for v in C.HOURLY_VARS]
)
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("daily", DAILY_SCHEMA),
        T.StructField("hourly", HOURLY_SCHEMA),
    ]
)


def parse_documents(raw: DataFrame, schema: T.StructType = PAYLOAD_SCHEMA, file_col: str = "source_file") -> DataFrame:
    """Text rows (``value``: one JSON object or array of objects) -> one row per
    location object with its position ``pos`` in the document."""
    v = F.col("value")
    docs = F.when(F.ltrim(v).startswith("["), F.from_json(v, T.ArrayType(schema))).otherwise(
        F.array(F.from_json(v, schema))
    )
    rows = raw.select(F.col(file_col), F.posexplode(docs).alias("pos", "o"))
    return rows.select(
        F.coalesce(F.col("o.chunk").cast("string"), F.col(file_col)).alias("chunk"),
        "pos", file_col, "o.latitude", "o.longitude", "o.daily", "o.hourly",
    )


def read_payloads(spark: SparkSession, path: str, whole_file: bool = False,
                  schema: T.StructType = PAYLOAD_SCHEMA) -> DataFrame:
    """One row per location object with its position ``pos`` in the response.

    A document is one object or an array of objects.  ``whole_file=True``
    reads each file as one (possibly pretty-printed) document; otherwise each
    line is a document, which keeps large landings splittable.  ``chunk`` is
    the object's own chunk id when present, else the source file.
    """
    raw = spark.read.text(path, wholetext=whole_file).select("value", F.col("_metadata.file_path").alias("source_file"))
    return parse_documents(raw, schema)


def _flatten(payloads: DataFrame, part: str, names: list[str], keys: list[str]) -> DataFrame:
    """Parallel arrays -> rows.  A variable missing from a payload is an
    empty array, so its values are null and the other variables still come
    through (``arrays_zip`` would return null if any input were null)."""
    empty_d = F.array().cast("array<double>")
    fields = [F.col(f"{part}.time").alias("time")] + [
        F.coalesce(F.col(f"{part}.{n}"), empty_d).alias(n) for n in names
    ]
    return payloads.select(*keys, F.inline(F.arrays_zip(*fields)))


def daily_rows(payloads: DataFrame, keys: list[str] = ("latitude", "longitude")) -> DataFrame:
    d = _flatten(payloads, "daily", C.DAILY_VARS, list(keys))
    return d.withColumn("day", F.to_date("time")).drop("time")


def hourly_rows(payloads: DataFrame, keys: list[str] = ("latitude", "longitude")) -> DataFrame:
    h = _flatten(payloads, "hourly", C.HOURLY_VARS, list(keys))
    return h.withColumn("time", F.to_timestamp_ntz("time"))


def write_payloads(locs: DataFrame, daily: DataFrame, hourly: DataFrame, loc: str, path: str) -> None:
    """Land per-location payloads in the service's JSON shape: one line per
    chunk holding the array of its location objects in ``pos`` order.

    ``locs``: loc, chunk, pos, latitude, longitude.  ``daily``: loc, day and the
    daily variables; ``hourly``: loc, time and the hourly variables.  A chunk is
    a bounded request (tens of locations) and a location's arrays cover a
    bounded forecast window, so every collect_list below is bounded.
    """
    dcols = [F.col("day").cast("string").alias("time")] + [F.col(v) for v in C.DAILY_VARS]
    hcols = [F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss").alias("time")] + [F.col(v) for v in C.HOURLY_VARS]
    d = daily.groupBy(loc).agg(F.sort_array(F.collect_list(F.struct(F.col("day").alias("o"), *dcols))).alias("d"))
    h = hourly.groupBy(loc).agg(F.sort_array(F.collect_list(F.struct(F.col("time").alias("o"), *hcols))).alias("h"))

    def field(n: str):
        return lambda s: s[n]

    def arrays(src: str, names: list[str]):
        return F.struct(*[F.transform(F.col(src), field(n)).alias(n) for n in names])

    obj = locs.join(d, loc, "left").join(h, loc, "left").select(
        "chunk", "pos",
        F.struct(
            F.col("chunk").cast("long").alias("chunk"), "latitude", "longitude",
            arrays("d", ["time", *C.DAILY_VARS]).alias("daily"),
            arrays("h", ["time", *C.HOURLY_VARS]).alias("hourly"),
        ).alias("obj"),
    )
    docs = obj.groupBy("chunk").agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("pos", "obj"))), lambda x: x["obj"])).alias("value")
    )
    docs.select("value").write.mode("overwrite").text(path)
