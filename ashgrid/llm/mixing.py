"""Mixing sources to target weights by systematic sampling.

Each source has a target number of words.  All documents of a source expect
``target / source size`` copies; the expected copies are prefix-summed within
the source (in order of size, so that every stretch of sizes is sampled at the
same rate), one offset per source is added, and a document is emitted once per
integer that its stretch of the sum crosses.

Defined results: a null or blank text has size 0; a null source is a source of
its own, ordered last; a source without words has target 0 and emits nothing;
repeated rows are separate documents; an empty table gives an empty result;
other columns of the input are carried in ``row`` and can have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import draw32, id_text, positions

SALTS = 64


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """(skey, source_size) -> + target, one row per source.

    Sources by code point, null last, take the weights in turn; they share the
    total, no source takes more than ``max_repeat`` times its size, and what it
    would take beyond is shared by the others by weight.  With the sources
    sorted by the share at which they reach their cap, the capped ones come
    first, so one running sum finds them all at once.
    """
    by_name = Window.orderBy("skey")
    w = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]),
                     (F.row_number().over(by_name) - 1) % len(weights) + 1)
    everything = Window.partitionBy(F.lit(0))
    s = (sizes.withColumn("w", w)
         .withColumn("cap", F.col("source_size") * max_repeat)
         .withColumn("total", F.sum("source_size").over(everything)))
    by_cap = Window.orderBy(F.col("cap").cast("double") / F.col("w"), "skey")
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    later = by_cap.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    s = s.withColumn("capped", F.col("cap") * F.sum("w").over(later) <= F.col("w") * left)
    rest = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    rest_w = F.sum(F.when(~F.col("capped"), F.col("w")).otherwise(0)).over(everything)
    return s.select("skey", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("w") * (rest.cast("double") / F.nullif(rest_w, F.lit(0)))).alias("target"))


def mix(docs: DataFrame, key: Column, source: Column, size: Column, weights: Sequence[int] = (1, 2, 3),
        max_repeat: int = 3, seed: str = "mix") -> DataFrame:
    """One row per input row: ``row`` (struct of all its columns), ``size``,
    ``source_size``, ``target`` (its source's) and ``copies`` (how often the
    mix emits it, at most ``max_repeat``).

    ``docs`` is read twice; materialize it first where ``size`` is costly.  The
    order inside a source is (size class, salt, size, key): size classes of at
    most an eighth of an octave, cut into a fixed number of salts, so that a
    hot source is numbered by many tasks.
    """
    src = source.cast("string")
    length = F.length(F.bin("size"))
    d = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
        F.when(src.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), src)).alias("skey"),
        id_text(key).alias("k"), key.alias("okey"),
    )
    d = d.withColumn("bucket", (length * 16 + F.expr("shiftright(size * 16, length(bin(size)))")) * SALTS
                     + draw32(F.lit(seed), F.col("k")) % SALTS)
    targets = source_targets(d.groupBy("skey").agg(F.sum("size").alias("source_size")), weights, max_repeat)
    ranked = positions(d, ["skey"], "bucket", [F.col("size"), F.col("okey")], "pos", targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = draw32(F.lit(seed), F.col("skey")) / F.lit(4294967296.0)
    upto = F.floor((F.col("pos") + 1) * rate + offset)
    return ranked.select(
        "row", "size", "source_size", "target", (upto - F.floor(F.col("pos") * rate + offset)).alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: the input's columns, each row as often as it has copies."""
    return (mixed.filter(F.col("copies") > 0)
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy"))
            .select("row.*"))
