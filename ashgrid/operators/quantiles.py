"""Exact order statistics of a whole column without gathering it (AGG-5).

A column's median needs a position in the order of all its values.  Buckets come
from a mergeable sketch (1,001 approximate cuts), whose rank error is far below
the width of a bucket; counting says which buckets the middle lies in, and only
their rows are looked at again, in finer buckets of their own.  After two rounds
about a hundred-thousandth of the rows is left, and a running sum over their
value counts selects the exact value.  Each round is one scan with map-side
aggregation; no task gets the values, or distinct values, of the column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUTS = 1000
ACCURACY = 10_000  # rank error of a cut: a ten-thousandth of the rows, a tenth of a bucket


def _cuts(v: Column) -> Column:
    return F.percentile_approx(v, [i / CUTS for i in range(CUTS + 1)], ACCURACY)


def _around(cuts: Column, share: Column, far: int) -> Column:
    """The cut ``far`` buckets from a share of the rows; null beyond the ends."""
    at = (F.floor if far < 0 else F.ceil)(share * CUTS) + far
    return F.when((at >= 0) & (at <= CUTS), F.get(cuts, at.cast("int")))


def median(df: DataFrame, c: str) -> DataFrame:
    """One row ``m``: the exact median of the values that are not null (mean of
    the two middle ones), null when there is none."""
    v = F.col("v")
    df = df.select(F.col(c).cast("double").alias("v")).filter(v.isNotNull())

    # ranks, from 0, of the two middle values
    lower, upper = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    first = df.agg(F.count(v).alias("n"), _cuts(v).alias("cuts"))
    first = first.select("n", lower.alias("lo_rank"), upper.alias("hi_rank"),
                         _around(F.col("cuts"), F.try_divide("lo_rank", "n"), -1).alias("a"),
                         _around(F.col("cuts"), F.try_divide("hi_rank", "n"), 1).alias("b"))
    held = first.select(F.struct("*")).scalar()

    def between(a: Column, b: Column) -> Column:
        return (a.isNull() | (v >= a)) & (b.isNull() | (v <= b))

    inside = F.when(between(held["a"], held["b"]), v)
    second = df.agg(F.count(F.when(held["a"].isNotNull() & (v < held["a"]), v)).alias("below"), F.count(inside).alias("m"),
                    _cuts(inside).alias("cuts"))
    share = lambda rank: F.try_divide(held[rank] - F.col("below"), F.col("m"))
    second = second.select(
        F.coalesce(_around(F.col("cuts"), share("lo_rank"), -1), held["a"]).alias("a"),
        F.coalesce(_around(F.col("cuts"), share("hi_rank"), 1), held["b"]).alias("b"))
    near = second.select(F.struct("*")).scalar()

    # all smaller values are one group (null), which the running sum starts with
    few = (df.filter(near["b"].isNull() | (v <= near["b"]))
           .groupBy(F.when(near["a"].isNull() | (v >= near["a"]), v).alias("v")).agg(F.count(F.lit(1)).alias("c")))
    upto = F.sum("c").over(Window.orderBy(F.col("v").asc_nulls_first()))
    ranked = few.select("v", upto.alias("upto"), (upto - F.col("c")).alias("before"))
    at = lambda rank: F.max(F.when((F.col("before") <= held[rank]) & (F.col("upto") > held[rank]), v))
    found = ranked.agg(at("lo_rank").alias("x"), at("hi_rank").alias("y"))
    return found.select(F.when(F.col("x") == F.col("y"), F.col("x")).otherwise(0.5 * F.col("x") + 0.5 * F.col("y")).alias("m"))
