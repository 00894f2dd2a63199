"""Shared pieces of the text operators: tables, words, row keys, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: the white space of every operator here: space and \t \n \v \f \r
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back: cuts
    lineage, and a lost executor never makes a later stage recompute it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str | Column = "text") -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.coalesce(c.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text that is not null (a split at one character
    is several times faster than a regular expression for each word)."""
    return F.array_remove(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), "")


def draw32(*parts: Column) -> Column:
    """A number in [0, 2^32) decided by the parts alone; any engine can repeat it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def id_text(c: Column) -> Column:
    """A text for a key that may be null ('' is no number, so null stays apart)."""
    return F.coalesce(c.cast("string"), F.lit(""))


def positions(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], out: str,
              of_group: DataFrame | None = None) -> DataFrame:
    """0-based gapless position of each row inside its group, ordered by
    (``bucket``, ``order``), without putting a group into one task: rows are
    numbered per (group, bucket), and each bucket starts after the counted
    rows of the buckets before it.  ``group`` and ``bucket`` must not be null;
    the number of buckets of a group is bounded by the caller.  ``of_group``
    (group columns and more) is joined on the way, to the buckets and not to
    the rows."""
    keys = [*group, bucket]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    if of_group is not None:
        starts = starts.join(of_group, list(group))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.join(starts, keys)
        .withColumn(out, F.col("__start") + inside - 1)
        .drop("__start")
    )


def row_key(*cols: Column) -> list[Column]:
    """Two 64-bit hashes, h1 and h2, that name a row by the given values: never
    null, equal for repeated rows, and the same whenever a task is run again."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols] + [F.concat(*[F.isnull(c).cast("string") for c in cols])]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(7), *parts).alias("h2")]
